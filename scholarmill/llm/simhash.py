"""Near copies by SimHash fingerprints of 64 bits, found with Golay codes.

Two fingerprints are linked when they differ in at most two bits. A fingerprint is cut into segments of 23, 23 and 18
bits. Two errors fall into the segments so that, going round, some segment is equal while the next has at most one
error. A key is therefore a whole segment with one of the nearby codeword indices of the next segment, three kinds of
keys with one or six indices each; linked fingerprints share a key. Fingerprints that share a key are compared.

Equal fingerprints are one row throughout, however many documents have them. A key that more than ``CROWD``
fingerprints share is not expanded into pairs: its members are keyed by every fingerprint at most one bit away, and all
who share such a key, being within two bits of one another, are linked to the smallest of them. Every link is then in
the same component as before, with as many rows as members.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm import golay
from scholarmill.llm.components import components
from scholarmill.llm.rows import arrow_type, column, fields, prepare, texts
from scholarmill.operators.ingest import fresh_name
from scholarmill.session import write_once

SHINGLE_WORDS, SEED, MOST_BITS = 3, 42, 2

#: Fingerprints of one key that are still compared pair by pair.
CROWD = 24

#: First bit and width of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))

#: Hashes that are counted at once.
PART = 1 << 16

BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str) -> int:
    """Bits set in over half the shingle hashes; no words give zero."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < SHINGLE_WORDS:
        return xxh64_intdigest(line, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    total = len(words) - SHINGLE_WORDS + 1
    counts = np.zeros((8, 256), dtype=np.int64)
    lanes = np.arange(0, 2048, 256, dtype=np.int64)
    for first in range(0, total, PART):
        hashes = [xxh64_intdigest(line[a:b - 1], SEED)
                  for a, b in zip(starts[first:min(first + PART, total)], ends[first + SHINGLE_WORDS - 1:])]
        raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((raw + lanes).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts[:, :, None] * BYTE_BITS[None]).sum(axis=1).ravel()
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp long)``: the 64 bits as a signed integer; a null text has no words."""
    return printed(texts(docs, id_col, text_col), ["doc_id"])


def printed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns of ``rows`` and ``fp``, the fingerprint of ``text``."""
    schema = pa.schema([*((name, arrow_type(rows, name)) for name in keep), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(0).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], schema=schema)

    return rows.select("text", *keep).mapInArrow(run, ", ".join([*(f"{name} {fields(rows, name)}" for name in keep), "fp bigint"]))


def keys(distinct: DataFrame) -> DataFrame:
    """``(key, fp)``: the Golay keys of each fingerprint."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            cut = [(fp.view(np.uint64) >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
                   for first, width in SEGMENTS]
            for kind in range(3):
                near = golay.indices(cut[(kind + 1) % 3])
                row, col = np.nonzero(near >= 0)
                key = (kind << 23 | cut[kind][row]) << 12 | near[row, col]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], schema=schema)

    return distinct.select("fp").mapInArrow(run, "key bigint, fp bigint")


def links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``(a, b)``: pairs of fingerprints at most two bits apart, whose components are those of all such pairs."""
    keyed = write_once(keys(distinct), "golay-keys")
    size = keyed.groupBy("key").count().filter("count > 1")
    shared = write_once(keyed.join(size, "key"), "golay-shared")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS
    few = shared.filter(F.col("count") <= crowd)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").filter(
        (F.col("a") < F.col("b")) & near).select("a", "b")
    members = shared.filter(F.col("count") > crowd).select("fp").distinct()
    flips = [0, *(1 << i if i < 63 else -(1 << 63) for i in range(64))]
    one_off = F.array(*(F.lit(x).cast("long") for x in flips))
    around = members.select("fp", F.explode(one_off).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("key"))
    least = around.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")
    stars = around.join(least, "key").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``; ``component_id`` is the smallest id reachable.

    Documents without words have fingerprint zero and are linked like any other. Repeated rows stay. A null id is in a
    class but never names it, unless its whole class has no id.
    """
    own = write_once(fingerprints(docs, id_col, text_col), "fingerprints")
    named = classed(own, crowd).select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def classed(own: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``(fp, root, component_id)`` of each fingerprint of ``own(doc_id, fp)``: fingerprints of a class share both."""
    distinct = write_once(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    groups = components(links(distinct, crowd))
    joined = distinct.join(groups, F.col("fp") == F.col("id"), "left").select(
        "fp", "least", F.coalesce("component_id", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(named, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each class, with all its columns, whatever they are named.

    It is the row with the smallest id, a row without an id only where the class has none; of rows with one id that with
    the least hash of the whole row, and of wholly repeated rows one. A row is known by its id and hash, which it has in
    every job; columns of maps do not count for the hash.
    """
    prepare(docs.sparkSession)
    hashed = [column(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    mark = F.xxhash64(*hashed)
    rows = docs.select(F.coalesce(column(text_col), F.lit("")).alias("text"), column(id_col).alias("doc_id"), mark.alias("mark"))
    own = write_once(printed(rows, ["doc_id", "mark"]), "marked-fingerprints")
    # a row per fingerprint first, so that a class with a third of all rows does not meet in one task
    first = own.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("stays"))
    stays = write_once(first.join(classed(own.select("doc_id", "fp")), "fp").groupBy("root").agg(F.min("stays").alias("stays")).select(
        F.col("stays.doc_id").alias("doc_id"), F.col("stays.mark").alias("mark")), "rows-that-stay")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.mark") == F.col("b.mark"))
    # copies are fewer than what stays, so they are what meets the documents, in the same way at every size
    goes = write_once(own.alias("a").join(stays.alias("b"), same, "left_anti").select(
        F.col("a.doc_id").alias("doc_id"), F.col("a.mark").alias("mark")).distinct(), "rows-that-go")
    again = write_once(own.alias("a").join(stays.alias("b"), same, "left_semi").groupBy("doc_id", "mark").count().filter("count > 1").select(
        "doc_id", "mark"), "rows-that-stay-once")
    names = fresh_name(docs, "_id"), fresh_name(docs, "_mark")
    marked = docs.withColumns({names[0]: column(id_col), names[1]: mark})

    def among(keys: DataFrame):
        return marked[names[0]].eqNullSafe(keys["doc_id"]) & (marked[names[1]] == keys["mark"])

    once = marked.join(again, among(again), "left_semi").dropDuplicates(list(names))
    kept = marked.join(goes.hint("merge"), among(goes), "left_anti").join(again, among(again), "left_anti").union(once)
    return kept.select(*(column(c) for c in docs.columns))


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
