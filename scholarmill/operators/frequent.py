"""The most frequent words and word pairs, exactly, from mergeable summaries.

A block of documents is counted in its task and summarised: its ``k`` most frequent terms with their counts, and as its
error the count of the most frequent term it leaves out. Summaries merge by adding counts and errors. In the merged
summary a term's true count lies between its sum and that sum plus the errors of the blocks that do not list it. Terms
whose upper bound falls below the lower bound of the last place cannot be among the first; what is left, the candidates,
is counted exactly in a second pass. Where the errors reach the last place, summaries were too short and are made anew
with more terms; as long as every term of every block they are the exact counts. So a shuffle carries summaries, not
words, and the outcome is that of a full count, ties included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import ship, write_once

#: Words counted together, and terms of a first summary for each term that is wanted. A block's arrays take some hundred
#: bytes a word, and every core of an executor holds one.
BLOCK_WORDS, PER_TERM = 500_000, 8

#: What Arrow hands over at once, documents at most and by size: a block ends with the batch that fills it, and a few
#: hundred long documents have many times its words.
FEW_AT_ONCE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "1m"}

#: Candidates at most, for each term that is wanted, that the second pass sends to its tasks.
CANDIDATES_PER_TERM = 40


def word_blocks(batches, size: int):
    """``(words, document)`` of about ``size`` words: documents are never split."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0))
        n += len(batch.column(0).values) if batch.num_rows else 0
        if n >= size:
            yield flat(held)
            held, n = [], 0
    if held:
        yield flat(held)


def flat(lists: list[pa.ListArray]) -> tuple[pa.Array, np.ndarray]:
    words = pa.concat_arrays([c.flatten() for c in lists])
    length = np.concatenate([pc.list_value_length(c).fill_null(0).to_numpy(zero_copy_only=False) for c in lists])
    return words, np.repeat(np.arange(len(length)), length)


def tallied(key: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(distinct, tf, df)`` of the keys of occurrences; documents are numbered and come in order."""
    order = np.argsort(key, kind="stable")
    key, document = key[order], document[order]
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    first = new | np.append(True, document[1:] != document[:-1])[:len(key)]
    at = np.flatnonzero(new)
    if not len(at):
        return key, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return key[at], np.diff(np.append(at, len(key))), np.add.reduceat(first.astype(np.int64), at)


def counted(words: pa.Array, document: np.ndarray) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The distinct words, and for words and pairs ``(key, tf, df)``; a pair's key is first word x width + second."""
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    width = max(1, len(coded.dictionary))
    together = np.flatnonzero(document[1:] == document[:-1])
    pairs = ids[together] * width + ids[together + 1]
    return coded.dictionary, [tallied(ids, document), tallied(pairs, document[together])]


def spelled(words: pa.Array, key: np.ndarray, pairs: bool) -> pa.Array:
    if not pairs:
        return words.take(pa.array(key))
    width = max(1, len(words))
    return pc.binary_join_element_wise(words.take(pa.array(key // width)), words.take(pa.array(key % width)), " ")


def summaries(tokens: DataFrame, k: int, block_words: int) -> DataFrame:
    """``(term, tf, df, error)``: per block its ``k`` most frequent words and pairs; a row without a term has the error alone."""
    schema = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64()), ("error", pa.int64())])

    def run(batches):
        for words, document in word_blocks(batches, block_words):
            names, parts = counted(words, document)
            every = np.concatenate([tf for _, tf, _ in parts])
            keep = np.ones(len(every), dtype=bool)
            error = 0
            if len(every) > k:
                order = np.argpartition(-every, k - 1)
                keep[order[k:]] = False
                error = int(every[order[k:]].max())
            begin = 0
            for pairs, (key, tf, df) in enumerate(parts):
                own = keep[begin:begin + len(tf)]
                begin += len(tf)
                term = spelled(names, key[own], bool(pairs))
                yield pa.RecordBatch.from_arrays([term, pa.array(tf[own]), pa.array(df[own]), pa.array(np.full(len(term), error))], schema=schema)
            yield pa.RecordBatch.from_pydict({"term": [None], "tf": [0], "df": [0], "error": [error]}, schema=schema)

    return tokens.select("words").mapInArrow(run, "term string, tf bigint, df bigint, error bigint")


def exact_counts(tokens: DataFrame, terms: list[str], block_words: int) -> DataFrame:
    """``(term, tf, df)`` of the given words and pairs."""
    schema = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])
    known = sorted({w for t in terms for w in t.split(" ")})
    number = {w: i for i, w in enumerate(known)}
    wanted = [sorted((number[t], t) for t in terms if " " not in t),
              sorted((number[a] * len(known) + number[b], t) for t in terms if " " in t for a, b in [t.split(" ")])]

    def run(batches):
        value_set = pa.array(known, pa.string())
        for words, document in word_blocks(batches, block_words):
            ids = pc.index_in(words, value_set=value_set).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            together = np.flatnonzero((document[1:] == document[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0))
            single = np.flatnonzero(ids >= 0)
            occurrences = [(ids[single], document[single]), (ids[together] * len(known) + ids[together + 1], document[together])]
            for listed, (key, own) in zip(wanted, occurrences):
                keys = np.array([x for x, _ in listed], dtype=np.int64)
                inside = np.isin(key, keys)
                found, tf, df = tallied(key[inside], own[inside])
                term = pa.array([t for _, t in listed], pa.string()).take(pa.array(np.searchsorted(keys, found)))
                yield pa.RecordBatch.from_arrays([term, pa.array(tf), pa.array(df)], schema=schema)

    return tokens.select("words").mapInArrow(run, "term string, tf bigint, df bigint").groupBy("term").agg(
        F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def most_frequent(tokens: DataFrame, wanted: int, least_df: int, k: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(term, tf, df)``: of the words and pairs in ``least_df`` documents and more the ``wanted`` most frequent.

    ``tokens`` has ``words``, an array per document; null arrays hold nothing. Order of equal counts: by term.
    """
    ship(tokens.sparkSession)
    k = k or wanted * PER_TERM
    while True:
        merged = write_once(summaries(tokens, k, block_words).groupBy("term").agg(
            F.sum("tf").alias("tf"), F.sum("df").alias("df"), F.sum("error").alias("error")), "frequent-terms")
        total = merged.filter("term IS NULL").agg(F.coalesce(F.sum("error"), F.lit(0)).alias("error")).first()["error"]
        terms = merged.filter("term IS NOT NULL")
        best = terms.filter(F.col("df") >= least_df).orderBy(F.desc("tf"), "term").select("term", "tf", "df").limit(wanted)
        if total == 0:
            return best
        last = best.agg(F.min("tf").alias("tf"), F.count("*").alias("n")).first()
        most = wanted * CANDIDATES_PER_TERM
        if last["n"] == wanted and total < last["tf"]:
            # a sum lacks at most the errors of the blocks that do not list the term
            candidates = [r["term"] for r in terms.filter(F.col("tf") + total - F.col("error") >= last["tf"]).select("term").limit(most + 1).collect()]
            if len(candidates) <= most:
                return exact_counts(tokens, candidates, block_words).filter(F.col("df") >= least_df).orderBy(F.desc("tf"), "term").limit(wanted)
        k *= 8
