"""Removal of long byte strings that also start earlier, by suffix sorting of what can repeat.

A window is a string of ``length`` bytes. Among its grams of ``GRAM`` bytes the one with the least hash is its anchor, so
equal windows have equal anchors at equal offsets, wherever they stand. A text is a row of anchors, each with the
windows that it serves (its context, about a third of ``length`` windows). From this:

1. Anchors whose hash occurs once serve no repeated window; they are counted out by hash and dropped.
2. Contexts that are equal as a whole (by hash) are grouped. All but the first repeat it; only the first goes on, and
   only if its anchor has other contexts as well.
3. Those first contexts are dealt out by anchor, so that all places of a window meet in one task, and suffix-sorted in
   blocks (two-stage sorting, see ``suffixes``). Neighbours in the order with ``length`` bytes in common are equal
   windows; all but the earliest are repeats.
4. An anchor with more than ``CROWD`` contexts is not gathered: its windows are grouped by their own bytes, with partial
   aggregates, which finds the same repeats.

What is shuffled are anchors and contexts; texts are shuffled twice, to cut out the contexts and to cut the repeats.

A row is known by its id and the hash of its text. Both come from the row itself, so every job, and every attempt of a
task, finds the same row under the same name, however files are split. Wholly repeated rows share a name; the first of
them stands for all, and the others repeat it from their first byte to their last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.rows import arrow_type, fields, texts
from scholarmill.llm.suffixes import shared_windows
from scholarmill.session import write_once

LENGTH, GRAM = 100, 32

#: Contexts of one anchor that are still gathered in one task, and bytes of contexts that are sorted together.
CROWD, BLOCK_BYTES = 20_000, 4_000_000

#: Bytes of a text whose anchors are found at once; places within them fit the low bits of a key.
PIECE, PLACE_BITS = 1 << 22, 23
PLACES = np.uint64((1 << PLACE_BITS) - 1)

#: Odd multipliers of the hash (fixed values; any odd numbers will do).
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes, a power of two, at each place."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * MIX[0]
    size = 1
    while size < gram:
        h = h[:-size] * MIX[size.bit_length() % len(MIX)] + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    h *= MIX[-1]
    h ^= h >> np.uint64(32)
    return h


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, first, n)``: for each anchor in turn its hash, the first window it serves and how many."""
    hashes, firsts, counts = [], [], []
    windows = len(raw) - length + 1
    step = PIECE - length + 1
    for begin in range(0, max(windows, 0), step):
        part = raw[begin:begin + PIECE]
        h = gram_hashes(part, gram)
        # the least hash, the leftmost among equals: the place is part of the key
        least = h & ~PLACES | np.arange(len(h), dtype=np.uint64)
        span, size = length - gram + 1, 1
        while 2 * size <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[:size - span], least[span - size:])
        at = (least & PLACES).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        hashes.append(h[at[first]])
        firsts.append(first + begin)
        counts.append(np.diff(np.append(first, len(at))))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(counts)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row, doc_id, text)``; ``row`` is the hash of the text, which tells rows of one id apart."""
    return texts(docs, id_col, text_col).select(F.xxhash64("text").alias("row"), "doc_id", "text")


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["row"] == right["row"])


def anchored(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``(doc_id, row, first, n, anchor, context)`` of every anchor; ``context`` is a hash of the context's bytes."""
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("row", pa.int64()), ("first", pa.int32()), ("n", pa.int32()),
                        ("anchor", pa.int64()), ("context", pa.int64())])

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows_, keys, out = [], [], []
            for row, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = text.encode("utf-8", "surrogatepass")
                if len(own) < length:
                    continue
                anchor, first, n = anchors(np.frombuffer(own, dtype=np.uint8), length, gram)
                ends = (first + n + (length - 1)).tolist()
                context = np.array([digest(own[a:b]) for a, b in zip(first.tolist(), ends)], dtype=np.uint64)
                rows_.append(np.full(len(first), row))
                keys += [key] * len(first)
                out.append((first, n, anchor, context))
            if out:
                first, n, anchor, context = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, schema.field(0).type), pa.array(np.concatenate(rows_)), pa.array(first.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))], schema=schema)

    return rows.select("row", "doc_id", "text").mapInArrow(
        run, f"doc_id {fields(rows, 'doc_id')}, row bigint, first int, n int, anchor bigint, context bigint")


def owner(first: str = "first") -> Column:
    """What orders the places of a string: smaller id (null first), then the text's hash, then place."""
    return F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "row", F.col(first).alias("first"))


def cut_contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted(doc_id, row, first, n, anchor)`` with the bytes of each context."""
    by_row = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("wanted"))
    joined = rows.join(by_row.hint("shuffle_hash"), same_row(rows, by_row)).select(rows["row"], rows["doc_id"], "text", "wanted")
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", arrow_type(rows, "doc_id")), ("row", pa.int64()), ("first", pa.int32()),
                        ("n", pa.int32()), ("bytes", pa.binary())])

    def run(batches):
        for batch in batches:
            out = {name: [] for name in schema.names}
            for row, key, text, own in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                for w in own:
                    out["anchor"].append(w["anchor"])
                    out["doc_id"].append(key)
                    out["row"].append(row)
                    out["first"].append(w["first"])
                    out["n"].append(w["n"])
                    out["bytes"].append(raw[w["first"]:w["first"] + w["n"] + length - 1])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return joined.mapInArrow(run, f"anchor bigint, doc_id {fields(rows, 'doc_id')}, row bigint, first int, n int, bytes binary")


def sorted_repeats(contexts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """``(doc_id, row, first, last)``: runs of windows in ``contexts`` that also start earlier, by suffix sorting per anchor."""
    schema = pa.schema([("doc_id", arrow_type(contexts, "doc_id")), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def found(held):
        """``held``: (doc_id, row, first, n, bytes) of whole anchors, together one text."""
        first = np.array([h[2] for h in held])
        # the rank of each context's row among the ids; places decide within a row
        order = sorted(range(len(held)), key=lambda i: (held[i][0] is not None, held[i][0] or 0, held[i][1]))
        rank = np.empty(len(held), dtype=np.int64)
        at = 0
        for k, i in enumerate(order):
            at += k > 0 and held[i][:2] != held[order[k - 1]][:2]
            rank[i] = at
        number, string, place = shared_windows([h[4] for h in held], np.array([h[3] for h in held]), length)
        place = place + first[string]
        by = np.lexsort((place, rank[string], number))
        later = np.append(False, number[by][1:] == number[by][:-1])[:len(by)]
        string, place = string[by[later]], place[by[later]]
        own = rank[string]
        by = np.lexsort((place, own))
        string, own, place = string[by], own[by], place[by]
        new = np.append(True, (own[1:] != own[:-1]) | (place[1:] > place[:-1] + 1))[:len(own)]
        last = np.append(new[1:], True)[:len(own)]
        of = [held[i] for i in string[new].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in of], schema.field(0).type), pa.array([h[1] for h in of], pa.int64()),
             pa.array(place[new].astype(np.int32)), pa.array(place[last].astype(np.int32))], schema=schema)

    def run(batches):
        held, size, key, seen = [], 0, None, set()
        for batch in batches:
            for anchor, *own in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != key and size >= block_bytes:
                    yield found(held)
                    held, size = [], 0
                if anchor != key:
                    key, seen = anchor, set()
                if (place := tuple(own[:3])) in seen:
                    continue  # of a wholly repeated row
                seen.add(place)
                held.append(own)
                size += len(own[-1])
        if held:
            yield found(held)

    # an anchor has CROWD contexts at most here
    return contexts.select("anchor", "doc_id", "row", "first", "n", "bytes").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        run, f"doc_id {fields(contexts, 'doc_id')}, row bigint, first int, last int")


def crowded_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of crowded anchors: windows are grouped by their bytes; no anchor is gathered."""
    windows = contexts.select("doc_id", "row", "first", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")).select(
        F.substring("bytes", F.col("i") + 1, F.lit(length)).alias("window"), "doc_id", "row", (F.col("first") + F.col("i")).alias("first"))
    earliest = windows.groupBy("window").agg(F.min(owner()).alias("least"), F.count("*").alias("n")).filter("n > 1").select("window", "least")
    later = windows.join(earliest, "window").filter(F.col("least") < owner())
    return later.select("doc_id", "row", "first", F.col("first").alias("last"))


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, row, first, last)``: runs of starts of windows that also start earlier; runs of a row may touch or overlap."""
    every = anchored(rows, length, gram)
    # written first, here and below: a join of two plain shuffles lets the planner split an anchor that has many rows
    repeated = write_once(every.groupBy("anchor").count().filter("count > 1").select("anchor"), "repeated-anchors")
    places = write_once(every.join(repeated, "anchor", "left_semi"), "anchors")
    # places of each context: the first stays, the others repeat all its windows
    grouped = places.groupBy("anchor", "context").agg(F.min(F.struct(owner().alias("at"), "n")).alias("least"))
    firsts = write_once(grouped.select("anchor", "context", F.col("least.at").alias("least"), F.col("least.n").alias("n")), "contexts")
    copies = places.join(firsts.select("anchor", "context", "least"), ["anchor", "context"]).filter(F.col("least") < owner())
    whole = write_once(copies.select("doc_id", "row", "first", (F.col("first") + F.col("n") - 1).alias("last")), "whole-repeats")
    several = write_once(firsts.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "several-contexts")
    wanted = firsts.join(several, "anchor").select("anchor", "contexts", F.col("least.doc_id").alias("doc_id"), F.col("least.row").alias("row"),
                                                   F.col("least.first").alias("first"), "n")
    crowds = several.filter(F.col("contexts") > crowd).select("anchor")
    contexts = cut_contexts(rows, wanted, length)
    if crowds.isEmpty():
        return whole.union(write_once(sorted_repeats(contexts, length, block_bytes), "sorted-repeats"))
    contexts = write_once(contexts, "context-bytes")
    few = contexts.join(crowds, "anchor", "left_anti")
    many = contexts.join(crowds, "anchor", "left_semi")
    return whole.union(write_once(sorted_repeats(few, length, block_bytes), "sorted-repeats")).union(
        write_once(crowded_repeats(many, length), "crowded-repeats"))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
           crowd: int = CROWD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, spans array<struct<first,last>>, kept binary)``, one row per row of ``docs``.

    Each byte goes that is covered by a string of ``length`` bytes which also starts earlier: in a smaller id, or before
    it in the same text. ``spans`` are the maximal removed runs, ``last`` exclusive; strings are judged on the input.
    Null ids count as the smallest; rows of one id follow one another by the hashes of their texts; of wholly repeated
    rows all but one repeat that one. Null and empty texts have no bytes. ``kept`` may cut through a character.
    """
    rows = keyed(docs, id_col, text_col)
    # no rows where ids are unique, so the planner sends them to the texts and not the texts to them
    repeated = write_once(rows.groupBy("doc_id", "row").count().filter("count > 1").select("doc_id", "row"), "repeated-rows")
    runs = repeats(rows, length, gram, crowd, block_bytes).groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    joined = rows.join(runs.hint("shuffle_hash"), same_row(rows, runs), "left").select(rows["doc_id"], rows["row"], "text", "runs")
    same = joined["doc_id"].eqNullSafe(repeated["doc_id"]) & (joined["row"] == repeated["row"])
    everything = F.array(F.struct(F.lit(0).alias("first"), (F.octet_length("text") - length).alias("last")))
    # written, so that each has one number whatever is computed again; the least stands for its like
    several = write_once(joined.join(repeated, same, "left_semi").withColumn("number", F.monotonically_increasing_id()), "numbered-rows")
    least = several.groupBy(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row")).agg(F.min("number").alias("least"))
    again = F.when((F.col("number") > F.col("least")) & (F.octet_length("text") >= length), everything).otherwise(F.col("runs"))
    several = several.join(least, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row"))).select(
        "doc_id", "text", again.alias("runs"))
    joined = joined.join(repeated, same, "left_anti").select("doc_id", "text", "runs").union(several)
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    schema = pa.schema([("doc_id", arrow_type(rows, "doc_id")), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for first, last in sorted((r["first"], r["last"] + length) for r in own or ()):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                edges = [0, *(x for m in merged for x in m), len(raw)]
                sizes.append(len(raw))
                spans.append([{"first": a, "last": b} for a, b in merged])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], schema=schema)

    return joined.mapInArrow(run, f"doc_id {fields(rows, 'doc_id')}, n_bytes bigint, spans array<struct<first:bigint,last:bigint>>, kept binary")


def digests(removed: DataFrame) -> DataFrame:
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return removed.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
