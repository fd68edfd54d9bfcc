"""Licence notices by diagonal voting.

1. A task cuts texts into words and hashes every run of ``k`` words, two for short templates and four for long ones.
   A bit table of the templates' hashes keeps back what cannot join; the others go to Spark as ``(place, hash)``.
2. The hashes are joined to the places of the templates' runs. A pair of places votes for the diagonal
   ``place in document - place in template``; votes are summed per diagonal.
3. Diagonals that lie no further apart than a notice may have edits are merged. With as many edits as it may have, a
   notice keeps ``runs - k x edits`` votes, so groups with fewer are no notice.
4. What is left is verified on the words: a phrase must stand word for word on its diagonal; a notice is aligned with
   the stretch of text that its group spans, at any start and end, and one word in ``WORDS_AN_EDIT`` may be changed,
   inserted or removed, the first and last too, but not those that name the licence or its version, and no name of
   another licence may stand in between.

Hashes alone are shuffled; texts are read again for step 4, and only those with something to verify are sent on. The
work of a text grows with its words. Rows are known by their id and the hash of their text, in every job alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmill.llm.leaks import TABLE, words_of
from scholarmill.llm.licence_texts import BODIES
from scholarmill.llm.rows import arrow_type, fields, texts, words_between
from scholarmill.session import write_once

#: Words of a run: for templates of ``LONG`` words and more, for shorter ones, for single words.
RUNS, LONG = (4, 2, 1), 20

#: Distance of diagonals that are always neighbours, words of a notice for each edit it may have.
GAP, WORDS_AN_EDIT = 2, 5

#: Words that name a licence, and its version where a notice names one.
NAMES = ("mit", "apache", "bsd", "gnu", "lesser", "library", "affero", "mozilla", "creative", "attribution", "cc", "nc", "sa", "nd",
         "noncommercial", "commercial", "sharealike", "alike", "noderivatives", "noderivs")
VERSIONS = ("2", "3")

#: Bytes of texts that are hashed together, bits of the table of hashes.
BLOCK_BYTES, TABLE_BITS = 1 << 23, 1 << 22

#: Fixed phrases whose words must stand consecutively, by label.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Looser notices, by label; the whole texts of licences come with them.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    *BODIES,
)

#: What lies between words once texts went through ``TABLE``.
BLANK = np.isin(np.arange(256), 0x20)

#: Odd multiplier of the hash of a run (a fixed value; any odd number will do).
MIX = np.uint64(0x9E3779B97F4A7C15)


class Template:
    """A phrase or notice with what it asks for."""

    def __init__(self, number: int, label: str, exact: bool, text: str):
        self.number, self.label, self.exact, self.words = number, label, exact, words_of(text)
        n = len(self.words)
        self.k = next(k for k, least in zip(RUNS, (LONG, 2, 0)) if n >= least)
        self.n_runs = max(0, n - self.k + 1)
        self.edits = 0 if exact else n // WORDS_AN_EDIT
        names = set(self.words) & {w.encode() for w in NAMES}
        self.names = names | (set(self.words) & {w.encode() for w in VERSIONS} if names else set())
        self.others = {w.encode() for w in NAMES} - set(self.words)

    def hashes(self) -> np.ndarray:
        return run_hashes(np.array([word_hash(w) for w in self.words], dtype=np.uint64), self.k)


def listed(phrases, notices) -> list[Template]:
    """All templates that have words, numbered in their order."""
    own = [(label, True, text) for label, text in phrases] + [(label, False, text) for label, text in notices]
    return [t for i, (label, exact, text) in enumerate(own) if (t := Template(i, label, exact, text)).words]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, by place; different for different ``k``."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ words[j:n + j]) * MIX
        out ^= out >> np.uint64(29)
    return out


def bit_table(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(TABLE_BITS, dtype=bool)
    table[hashes % np.uint64(TABLE_BITS)] = True
    return table


def text_blocks(batches, size: int):
    """``(ids, rows, texts)`` of about ``size`` bytes, the texts written as words with blanks between."""
    held, total = ([], [], []), 0
    for batch in batches:
        for key, row, text in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode("utf-8", "surrogatepass").translate(TABLE)
            for part, x in zip(held, (key, row, raw)):
                part.append(x)
            total += len(raw) + 50
            if total >= size:
                yield held
                held, total = ([], [], []), 0
    if held[0]:
        yield held


def hits(rows: DataFrame, templates: list[Template]) -> DataFrame:
    """``(doc_id, row, n_words, hits array<struct<place,hash>>)``: the runs of each text that may be a template's."""
    tables = {k: bit_table(np.concatenate([t.hashes() for t in templates if t.k == k])) for k in sorted({t.k for t in templates})}
    hit = pa.struct([("place", pa.int32()), ("hash", pa.int64())])
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("row", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(hit))])

    def run(batches):
        for ids, marks, raw in text_blocks(batches, BLOCK_BYTES):
            words, start = words_between(np.frombuffer(b" ".join(raw), dtype=np.uint8), BLANK)
            coded = words.dictionary_encode()
            own = np.array([word_hash(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)[coded.indices.to_numpy()]
            begin = np.append(0, np.cumsum([len(r) + 1 for r in raw]))[:-1]
            text = np.searchsorted(begin, start, side="right") - 1
            n_words = np.bincount(text, minlength=len(raw))
            first = np.cumsum(n_words) - n_words
            at, hashes = [], []
            for k, table in tables.items():
                found = run_hashes(own, k)
                own_text = text[:len(found)]
                may = np.flatnonzero(table[found % np.uint64(TABLE_BITS)] & (own_text == text[k - 1:k - 1 + len(found)]))
                at.append(may)
                hashes.append(found[may])
            at, hashes = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (at, hashes))
            at = at.astype(np.int64)
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            ends = np.append(0, np.cumsum(np.bincount(text[at], minlength=len(raw)))).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array((at - first[text[at]]).astype(np.int32)), pa.array(hashes.astype(np.uint64).view(np.int64))],
                                                fields=list(hit))
            yield pa.RecordBatch.from_arrays([pa.array(ids, schema.field(0).type), pa.array(marks, pa.int64()), pa.array(n_words, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends), values)], schema=schema)

    return rows.select("doc_id", "row", "text").mapInArrow(
        run, f"doc_id {fields(rows, 'doc_id')}, row bigint, n_words bigint, hits array<struct<place:int,hash:bigint>>")


def known_runs(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``(hash, template, at, n_runs, exact, reach, least)``, a row for each run of each template."""
    rows = [(int(h), t.number, at, t.n_runs, t.exact, max(GAP, t.edits), max(1, t.n_runs - t.k * t.edits))
            for t in templates for at, h in enumerate(t.hashes().view(np.int64))]
    return spark.createDataFrame(rows, "hash bigint, template int, at int, n_runs int, exact boolean, reach int, least int")


def groups(found: DataFrame, known: DataFrame) -> DataFrame:
    """``(doc_id, row, template, exact, low, high, enough, share)`` per group of neighbouring diagonals.

    For a phrase every diagonal is a group of its own.
    """
    placed = found.select("doc_id", "row", F.inline("hits")).join(known, "hash")
    template = ["template", "n_runs", "exact", "reach", "least"]
    votes = placed.groupBy("doc_id", "row", *template, (F.col("place") - F.col("at")).alias("diagonal")).agg(F.count("*").alias("votes"))
    near = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    apart = F.col("exact") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > F.col("reach"), F.lit(True))
    merged = votes.withColumn("group", F.sum(apart.cast("int")).over(near.rowsBetween(Window.unboundedPreceding, 0)))
    summed = merged.groupBy("doc_id", "row", *template, "group").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"))
    needed = F.when(F.col("exact"), F.col("n_runs")).otherwise(F.col("least"))
    return summed.select("doc_id", "row", "template", "exact", "low", "high", (F.col("votes") >= needed).alias("enough"),
                         F.least(F.lit(0.99), F.col("votes") / F.col("n_runs")).alias("share"))


def least_edits(template: Template, words: list[bytes]) -> int | None:
    """Least edits from a notice to a stretch of ``words`` that keeps its names and holds no other licence's; None if there is none."""
    best = None
    begin = 0
    for end in [*(i for i, w in enumerate(words) if w in template.others), len(words)]:
        found = aligned(template, words[begin:end])
        best = found if best is None or (found is not None and found < best) else best
        begin = end + 1
    return best


def aligned(template: Template, words: list[bytes]) -> int | None:
    """The same where no word is another licence's name: alignment with free ends, a row of the table for each word."""
    far = 1 << 30
    number = {w: i for i, w in enumerate(dict.fromkeys(template.words))}
    text = np.array([number.get(w, -1) for w in words], dtype=np.int64)
    step = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, dtype=np.int64)
    for w in template.words:
        same = text == number[w]
        if w in template.names:
            new = np.append(far, np.where(same, row[:-1], far))
        else:
            new = row + 1
            new[1:] = np.minimum(new[1:], row[:-1] + ~same)
        # words that the notice does not have
        row = np.minimum.accumulate(new - step) + step
    least = int(row.min())
    return least if least < far // 2 else None


def verified(docs: DataFrame, asked: DataFrame, templates: list[Template]) -> DataFrame:
    """``(doc_id, row, places, loose, best)`` of the texts with groups to verify, once for wholly repeated rows."""
    sent = docs.sparkSession.sparkContext.broadcast({t.number: t for t in templates})
    by_row = asked.groupBy("doc_id", "row").agg(F.collect_list(F.struct("template", "low", "high")).alias("asked"))
    by_row = write_once(by_row, "notices-to-verify")
    same = docs["doc_id"].eqNullSafe(by_row["doc_id"]) & (docs["row"] == by_row["row"])
    joined = docs.join(by_row, same).select(docs["doc_id"], docs["row"], "text", "asked")
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("row", pa.int64()), ("places", pa.list_(place)), ("loose", pa.list_(pa.string())),
                        ("best", pa.float64())])

    def run(batches):
        own = sent.value
        for batch in batches:
            out = []
            for key, row, text, groups_ in zip(*(c.to_pylist() for c in batch.columns)):
                words, places, loose, best = words_of(text), [], set(), 0.0
                for g in groups_:
                    t = own[g["template"]]
                    n = len(t.words)
                    if t.exact:
                        if words[g["low"]:g["low"] + n] == t.words:
                            places.append({"word": g["low"], "label": t.label})
                            best = 1.0
                        continue
                    edits = least_edits(t, words[max(0, g["low"] - t.edits):max(0, g["high"] + n + t.edits)])
                    if edits is not None and edits <= t.edits:
                        loose.add(t.label)
                        best = max(best, 1 - edits / n)
                out.append({"doc_id": key, "row": row, "places": sorted(places, key=lambda p: (p["word"], p["label"])), "loose": sorted(loose), "best": best})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return joined.mapInArrow(run, f"doc_id {fields(docs, 'doc_id')}, row bigint, places array<struct<word:bigint,label:string>>, "
                                  "loose array<string>, best double").dropDuplicates(["doc_id", "row"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``(doc_id, n_words, places array<struct<word,label>>, labels array<string>, score)``, one row per row of ``docs``.

    ``places`` are all starts of the fixed phrases, sorted; ``labels`` those of phrases and notices found, sorted;
    ``score`` is 1 for a fixed phrase, the share of a notice's words without edits if it is found, otherwise the largest
    share of a template's runs that votes in one group, below 1, and 0 if nothing votes. A null or empty text has no
    words; repeated rows stay; templates without words find nothing. The templates are the caller's own lists.
    """
    templates = listed(phrases, notices)
    rows = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("row"), "text")
    found = write_once(hits(rows, templates), "licence-hits")
    cast = write_once(groups(found, known_runs(docs.sparkSession, templates)), "licence-groups")
    seen = write_once(verified(rows, cast.filter("enough"), templates), "licence-notices")
    shares = cast.groupBy("doc_id", "row").agg(F.max("share").alias("share"))
    return named(found.select("doc_id", "row", "n_words"), seen, shares)


def named(found: DataFrame, seen: DataFrame, shares: DataFrame) -> DataFrame:
    def same(right: DataFrame) -> Column:
        return found["doc_id"].eqNullSafe(right["doc_id"]) & (found["row"] == right["row"])

    places = F.coalesce(seen["places"], F.array().cast("array<struct<word:bigint,label:string>>"))
    loose = F.coalesce(seen["loose"], F.array().cast("array<string>"))
    best = F.coalesce(F.when(seen["best"] > 0, seen["best"]), shares["share"], F.lit(0.0))
    return found.join(seen, same(seen), "left").join(shares, same(shares), "left").select(
        found["doc_id"], "n_words", places.alias("places"),
        F.array_sort(F.array_union(F.array_distinct(F.transform(places, lambda p: p["label"])), loose)).alias("labels"), best.alias("score"))


def digests(found: DataFrame) -> DataFrame:
    place = F.col("places.word")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.col("places.label"))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
