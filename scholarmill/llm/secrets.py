"""Secrets in texts: fixed patterns, and strings that a tokenizer finds strange.

The token-efficiency test encodes each candidate string under a tiktoken vocabulary. Words and names take few tokens
for their length; random strings take many, so a low number of characters per token exposes them. Digests, UUIDs and
sequences of numbers, which are random or dense by nature, are excluded beforehand; words joined by signs are judged by
the words alone.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.rows import arrow_type, fields, texts

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "sparse")

#: Fixed patterns. The key words are taken in either case, in ASCII only.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_?key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Strings that the token-efficiency test looks at, and the fewest characters per token of an ordinary one, which is less
#: for those under ``LONG`` characters, as their ratios scatter more.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LONG, LEAST_RATIO, LEAST_SHORT_RATIO = 20, 1.9, 1.8

#: Digests by their usual lengths, UUIDs, times and other sequences of numbers.
EXCLUDED = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9+/_=-]+(?:T[0-9+/_=-]+)?Z?)")

#: Groups of letters joined by signs, with or without numbers. With fewer letters than these, the groups of a key are
#: judged, letters and numbers alike, if they have as many characters together.
JOINED = re.compile(r"(?:[A-Za-z][a-z]*|[A-Z]+)(?:[_/+=-]+(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]{1,4}))+[_/+=-]*")
LETTERS, KEY_GROUPS, LEAST_LETTERS = re.compile(r"[A-Za-z]+"), re.compile(r"[A-Za-z0-9]{4,}"), 12


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(f"({'|'.join(map(either_case, KEY_WORDS))})"
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def strange(string: str, encoding) -> bool:
    """Whether a candidate has too few characters per token for words, names and numbers."""
    if EXCLUDED.fullmatch(string):
        return False
    parts = LETTERS.findall(string) if JOINED.fullmatch(string) else [string]
    if sum(map(len, parts)) < LEAST_LETTERS:
        parts = KEY_GROUPS.findall(string)
    n = sum(map(len, parts))
    if n < LEAST_LETTERS:
        return False
    return n < (LEAST_RATIO if len(string) >= LONG else LEAST_SHORT_RATIO) * sum(len(encoding.encode_ordinary(x)) for x in parts)


def spans(text: str, encoding) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind; code points, end exclusive."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        if strange(m[0], encoding):
            found.append(("sparse", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans array<struct<kind,start,end>>)``, one row per row of ``docs``.

    ``assign``, ``access`` and ``hex`` are fixed patterns, leftmost and not overlapping within a kind; ``sparse`` are
    strings with fewer than ``LEAST_RATIO`` (short ones ``LEAST_SHORT_RATIO``) characters per token. A null or empty text has no spans, repeated rows
    stay, whole texts are read, and no kind removes another's spans.
    """
    rows = texts(docs, id_col, text_col)
    key = arrow_type(rows, "doc_id")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", key), ("spans", pa.list_(span))])

    def run(batches):
        encoding = tokenizer(path, pattern)
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(text, encoding)]
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema.field(1).type)], schema=schema)

    return rows.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, "
                                "spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``scan`` replaced by ``mark`` (overlapping spans by one); a null text stays null.

    All columns and rows stay as they are but for the text.
    """
    from scholarmill.llm.rows import column, prepare

    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(held):
        encoding = tokenizer(path, pattern)
        return held.map(lambda text: None if text is None else cut(text, spans(text, encoding), mark))

    return docs.withColumn(text_col, clean(column(text_col)))


def cut(text: str, found: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if found else text


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``scan``, as ``kind:start:end`` joined by commas."""
    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "sparse")
    return scanned.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"))
