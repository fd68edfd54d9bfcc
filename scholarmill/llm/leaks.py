"""Benchmark passages in documents, by the multi-pattern search of Wu and Manber.

A pattern is a window of an item's words, written with one space before, between and after them; documents are written
alike, so that an occurrence of the bytes is an occurrence of the words. For the patterns of a class of lengths a shift
table says, for a block of bytes, how far the search may jump since no pattern has that block nearer to its end; where
the jump is zero, the bucket of the block's patterns is compared directly.

Patterns are taken to the documents, never the other way round: no text is shuffled. They are numbered and written as
files, a folder for each group of about ``GROUP_BYTES``; a task reads the groups one after the other, each for a block
of texts, and gives back numbers of windows. Which items hold a window is joined in Spark afterwards, once for every set
of windows that occurs, so neither many patterns nor a window that very many items share passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.rows import arrow_type, column, fields, prepare, texts
from scholarmill.session import fresh_path, write_once

WINDOW_WORDS = 10

#: Bytes of patterns that a task searches for at once, and bytes of texts that it holds meanwhile.
GROUP_BYTES, BLOCK_BYTES = 2_000_000, 32_000_000

#: Upper ends of the pattern lengths searched together; short patterns would shorten the jumps of long ones.
LENGTH_CLASSES = (8, 24, 48)

#: A-Z become a-z; digits, letters and all bytes above 0x7f belong to words; all else separates them.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


def windows(words: list[bytes], k: int) -> Iterable[list[bytes]]:
    """All runs of ``k`` words; all words if there are fewer, nothing if there are none."""
    return (words[i:i + k] for i in range(max(1, len(words) - k + 1))) if words else ()


class Search:
    """Shift tables and suffix buckets for one class of pattern lengths."""

    def __init__(self, patterns: list[bytes]):
        self.least = m = min(map(len, patterns))
        self.block = b = max(2, m // 4)
        self.jump = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for at in range(m - b + 1):
                part = p[at:at + b]
                far = m - b - at
                if far < self.shift.get(part, self.jump):
                    self.shift[part] = far
            self.bucket.setdefault(p[m - b:m], []).append(p)

    def find(self, line: bytes) -> list[tuple[int, bytes]]:
        """``(start, pattern)`` of every occurrence."""
        found = []
        b, back, jump, shift, last = self.block, self.least - self.block, self.jump, self.shift.get, len(line) - self.block
        at = back
        while at <= last:
            far = shift(line[at:at + b], jump)
            if far:
                at += far
                continue
            for p in self.bucket[line[at:at + b]]:
                if line.startswith(p, at - back):
                    found.append((at - back, p))
            at += 1
        return found


def searches(patterns: Iterable[bytes]) -> list[Search]:
    classes: dict[int, list[bytes]] = {}
    for p in patterns:
        classes.setdefault(sum(len(p) > end for end in LENGTH_CLASSES), []).append(p)
    return [Search(own) for _, own in sorted(classes.items())]


def runs(marked: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans, end exclusive, merged where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(marked):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search_words(words: list[bytes], own: list[Search]) -> tuple[list[tuple[int, int]], set[bytes]]:
    """Hit spans in words, and the patterns that occur."""
    line = b" " + b" ".join(words) + b" "
    marked, seen = [], set()
    for search in own:
        at = word = 0
        for start, p in search.find(line):
            word += line.count(b" ", at, start)
            at = start
            marked.append((word, word + p.count(b" ") - 1))
            seen.add(p)
    return runs(marked), seen


@dataclass(frozen=True)
class Patterns:
    """Numbered windows as files, a folder per group, and ``holders(number, item)``."""

    folder: str
    groups: int
    holders: DataFrame


def write_patterns(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = WINDOW_WORDS,
                   group_bytes: int = GROUP_BYTES) -> Patterns:
    spark = prepare(benchmark.sparkSession)
    rows = texts(benchmark, id_col, text_col).filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("string").alias("item"), "text")
    schema = pa.schema([("item", pa.string()), ("pattern", pa.binary())])

    def run(batches):
        for batch in batches:
            out = [(item, b" " + b" ".join(w) + b" ")
                   for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for w in windows(words_of(text), k)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()),
                                              pa.array([x[1] for x in out], pa.binary())], schema=schema)

    held = write_once(rows.mapInArrow(run, "item string, pattern binary").distinct(), "windows")
    known = write_once(held.select("pattern").distinct().withColumn("number", F.monotonically_increasing_id()), "patterns")
    total = known.agg(F.sum(F.octet_length("pattern"))).first()[0]
    groups = -(-(total or 0) // group_bytes) or 1
    folder = fresh_path(spark, "pattern-groups")
    known.withColumn("group", F.pmod(F.xxhash64("pattern"), F.lit(groups)).cast("int")).hint("rebalance", "group").write.partitionBy(
        "group").parquet(folder)
    return Patterns(folder, groups, write_once(held.join(known, "pattern").select("number", "item"), "window-items"))


@lru_cache(maxsize=1)
def group_of(folder: str, group: int) -> tuple[dict[bytes, int], list[Search]]:
    """The numbers of a group's patterns, and its searches."""
    store, place = pafs.FileSystem.from_uri(folder)
    own = f"{place}/group={group}"
    if store.get_file_info(own).type == pafs.FileType.NotFound:
        return {}, []
    files = [f.path for f in store.get_file_info(pafs.FileSelector(own)) if f.path.endswith(".parquet")]
    numbers: dict[bytes, int] = {}
    for path in sorted(files):
        with store.open_input_file(path) as file:
            held = pq.read_table(file, columns=["pattern", "number"])
        numbers.update(zip(held.column("pattern").to_pylist(), held.column("number").to_pylist()))
    return numbers, searches(numbers)


def held_blocks(batches, text_at: int) -> Iterator[list[list]]:
    """Columns of rows whose texts are about ``BLOCK_BYTES`` together."""
    held: list[list] = []
    total = 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        held = [a + b for a, b in zip(held, columns)] if held else columns
        total += sum(len(t or "") for t in columns[text_at])
        if total >= BLOCK_BYTES:
            yield held
            held, total = [], 0
    if held and held[0]:
        yield held


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         k: int = WINDOW_WORDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(doc_id, n_words, spans array<struct<first,last>>, items array<string>)``, one row per row of ``docs``.

    ``spans`` are the maximal runs of words inside any occurrence of a window of ``k`` consecutive item words (an item
    of fewer words is one window), ``last`` exclusive; ``items`` are the items with occurring windows, sorted as
    strings. Null and empty texts have no words; items without an id or without words are left out; an empty benchmark
    hits nothing; repeated rows stay.
    """
    known = write_patterns(benchmark, k=k, group_bytes=group_bytes)
    folder, groups = known.folder, known.groups
    rows = texts(docs, id_col, text_col)
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("n_words", pa.int64()), ("spans", span), ("windows", pa.list_(pa.int64()))])

    def run(batches):
        for ids, held in held_blocks(batches, 1):
            words = [words_of(text) for text in held]
            marked: list[list] = [[] for _ in ids]
            seen: list[list] = [[] for _ in ids]
            for group in range(groups):
                numbers, own = group_of(folder, group)
                for i, w in enumerate(words):
                    spans, occurring = search_words(w, own)
                    marked[i] += spans
                    seen[i] += map(numbers.__getitem__, occurring)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, schema.field(0).type), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([[{"first": a, "last": b} for a, b in runs(m)] for m in marked], span),
                 pa.array([sorted(x) for x in seen], pa.list_(pa.int64()))], schema=schema)

    found = write_once(rows.mapInArrow(
        run, f"doc_id {fields(rows, 'doc_id')}, n_words bigint, spans array<struct<first:bigint,last:bigint>>, windows array<bigint>"), "leaks")
    hit = found.filter(F.size("windows") > 0)
    # each set of windows meets its items once, however many documents have it
    sets = hit.select("windows").distinct()
    items = write_once(sets.select("windows", F.explode("windows").alias("number")).join(known.holders, "number").groupBy("windows").agg(
        F.sort_array(F.collect_set("item")).alias("items")), "items-of-windows")
    clear = found.filter(F.size("windows") == 0).select("doc_id", "n_words", "spans", F.array().cast("array<string>").alias("items"))
    return hit.join(items, "windows").select("doc_id", "n_words", "spans", "items").union(clear)


def digests(found: DataFrame) -> DataFrame:
    """Counts of hit words and items per document, and whether any word is hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", k: int = WINDOW_WORDS,
          group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows of ``docs`` without any hit word; all columns stay, and no text is shuffled."""
    known = write_patterns(benchmark, k=k, group_bytes=group_bytes)
    folder, groups = known.folder, known.groups

    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts_ in batches:
            words = [words_of(text or "") for text in texts_]
            hit = [False] * len(words)
            for group in range(groups):
                own = group_of(folder, group)[1]
                hit = [h or bool(search_words(w, own)[0]) for h, w in zip(hit, words)]
            yield pd.Series([not h for h in hit], dtype=bool)

    return docs.filter(free(column(text_col)))
