"""Phrases whose words stand together more often than their parts suggest, by weighted automata.

1. *Shards.* A task counts the word sequences of a block of texts, sorts them, and builds the acyclic automaton that
   gives each its count. A sequence begins with its language, so one order holds them all. The automaton is cut at fixed
   bounds of that order into prefix ranges.
2. *Union.* All automata of a range meet in one task, which adds them up as they come; what is held is merged again
   whenever it has doubled. A range is a stretch of about equally many sequences, wherever in a word's or a language's
   continuations its bounds lie, so neither a language nor a word is too much for a task. What is rarer than a candidate
   may be goes: the parts of a phrase are never rarer than the phrase.
3. *Lookups.* The parts of all candidates are sorted per range and composed with that range's automaton.

Scores, the drop of phrases within longer ones, and the best of each language are DataFrame operations.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmill.llm.automata import Automaton, Layer, added, at_least, composed, grouped, ordered, ranged
from scholarmill.llm.rows import column, prepare, words_between
from scholarmill.session import settings, write_once

#: Fixed values of the contract: words of a phrase, least count, share of a longer phrase that drops it, phrases a language.
LONGEST, LEAST, PER_CENT, BEST = 3, 10, 50, 2000

#: Scores are whole millionths.
UNIT = 1_000_000

#: Bytes of texts that are counted together; a longer text is counted in slices of this size.
BLOCK_BYTES = 1 << 23

#: Characters of text for each prefix range, fewest ranges, documents (about) whose sequences set the bounds, sequences of each.
RANGE_CHARS, FEWEST_RANGES, BOUND_DOCS, BOUND_SEQUENCES = 1 << 23, 16, 2000, 20

#: Shares of a language's phrases that are ranked by themselves.
SHARES = 16

#: Sequences of one range that are held before they are merged.
HELD = 1_000_000

#: Automata that Arrow hands over at once.
TOGETHER = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}

#: Between pieces; no byte of UTF-8.
BREAK = 0xFF

GAPS = np.isin(np.arange(256), (0x20, BREAK))

#: Lower case for A-Z, a break for what ends a piece, a blank for a tab (fixed values of the contract).
SIGNS = bytes(BREAK if c in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def tokens(held: list[tuple[bytes, bytes, int]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``(words, piece, text, counted)`` of all texts ``(lang, signs, limit)`` laid end to end.

    ``piece`` numbers the piece of each word; sequences are counted that start before a text's ``limit``.
    """
    raw = np.frombuffer(bytes([BREAK]).join(signs for _, signs, _ in held), dtype=np.uint8)
    words, start = words_between(raw, GAPS)
    piece = np.searchsorted(np.flatnonzero(raw == BREAK), start)
    begin = np.append(0, np.cumsum([len(signs) + 1 for _, signs, _ in held]))[:-1]
    text = np.searchsorted(begin, start, side="right") - 1
    limit = begin + np.array([limit for *_, limit in held])
    return words, piece, text, start < limit[text]


def counted(held: list[tuple[bytes, bytes, int]], longest: int) -> tuple[list[Layer], pa.Array]:
    """Layers of the sequences of 0 to ``longest`` words after their language; the language alone counts words."""
    words, piece, text, starts = tokens(held)
    if not len(words):
        return [], words
    distinct, place = ordered(pa.concat_arrays([words, pa.array([lang for lang, *_ in held], pa.binary())]))
    ids, langs = place[:len(words)], place[len(words):]
    at = np.flatnonzero(starts)
    if not len(at):
        return [], distinct
    symbols, node, _, begin = grouped(langs[text[at]])
    layers: list[Layer] = [(np.zeros(len(symbols), dtype=np.int64), symbols, np.diff(np.append(begin, len(at))))]
    for k in range(longest):
        follows = at + k < len(ids)
        follows[follows] = piece[at[follows] + k] == piece[at[follows]]
        at = at[follows]
        if not len(at):
            break
        key, node, _, begin = grouped(node[follows] * len(distinct) + ids[at + k])
        layers.append((key // len(distinct), key % len(distinct), np.diff(np.append(begin, len(at)))))
    return layers, distinct


def slices(signs: bytes, size: int, longest: int):
    """``(part, limit)`` of a text: parts begin where words do and go on for the words of a phrase beyond their limit."""
    begin = 0
    while begin < len(signs):
        if len(signs) - begin <= size:
            yield signs[begin:], len(signs) - begin
            return
        limit = end = next_gap(signs, begin + size)
        for _ in range(longest - 1):
            while end < len(signs) and signs[end] in (0x20, BREAK):
                end += 1
            end = next_gap(signs, end)
        yield signs[begin:end], limit - begin
        begin = limit


def next_gap(signs: bytes, at: int) -> int:
    found = [i for i in (signs.find(b" ", at), signs.find(bytes([BREAK]), at)) if i >= 0]
    return min(found, default=len(signs))


def blocks(batches, size: int, longest: int):
    """Lists of ``(lang, signs, limit)`` of about ``size`` bytes."""
    held, total = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part, limit in slices(text.translate(SIGNS), size, longest):
                held.append((lang, part, limit))
                total += len(part)
                if total >= size:
                    yield held
                    held, total = [], 0
    if held:
        yield held


def texts_by_language(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``(lang binary, text binary)``; a null language is ``und``, a null text empty."""
    prepare(docs.sparkSession)
    lang = F.coalesce(column(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.cast("binary").alias("lang"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))


def bounds_of(rows: DataFrame, longest: int, block_bytes: int, range_chars: int) -> list[tuple[bytes, ...]]:
    """Where prefix ranges begin: quantiles of the sequences of some documents. They balance tasks and change no result."""
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    wanted = max(FEWEST_RANGES, -(-size["bytes"] // range_chars))

    def run(batches):
        draw = np.random.default_rng(0)
        for held in blocks(batches, block_bytes, longest):
            layers, words = counted(held, longest)
            if not layers:
                continue
            chosen = np.sort(draw.choice(sum(len(x[0]) for x in layers), min(sum(len(x[0]) for x in layers), BOUND_SEQUENCES * len(held)), replace=False))
            out, begin = [], 0
            for depth, layer in enumerate(layers):
                own = chosen[(chosen >= begin) & (chosen < begin + len(layer[0]))] - begin
                begin += len(layer[0])
                path = []
                for k in range(depth, -1, -1):
                    path.append(words.take(pa.array(layers[k][1][own])).to_pylist())
                    own = layers[k][0][own]
                out += map(list, zip(*path[::-1]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.binary()))], names=["sequence"])

    some = rows.sample(min(1.0, BOUND_DOCS / max(1, size["n"])), seed=11)
    found = sorted(tuple(map(bytes, r.sequence)) for r in some.mapInArrow(run, "sequence array<binary>").toLocalIterator())
    return sorted({found[len(found) * i // wanted] for i in range(1, wanted)}) if found else []


def shards(rows: DataFrame, bounds: list[tuple[bytes, ...]], longest: int, block_bytes: int) -> DataFrame:
    """``(range, automaton)``: the automata of every block, cut into ranges."""
    def run(batches):
        for held in blocks(batches, block_bytes, longest):
            for number, automaton in ranged(*counted(held, longest), bounds):
                yield pa.RecordBatch.from_pydict({"range": pa.array([number], pa.int32()), "automaton": [automaton.packed()]})

    return rows.mapInArrow(run, "range int, automaton binary")


def union(parts: DataFrame, least: int) -> DataFrame:
    """``(range, automaton)``, one row per range: the sum of its automata, without sequences rarer than ``least``."""
    schema = pa.schema([("range", pa.int32()), ("automaton", pa.binary())])

    def run(batches):
        number, held, size, merged = None, [], 0, 0

        def done():
            return pa.RecordBatch.from_pydict({"range": [number], "automaton": [at_least(*added(held), least).packed()]}, schema=schema)

        for batch in batches:
            for own, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != number:
                    if held:
                        yield done()
                    number, held, size, merged = own, [], 0, 0
                part = Automaton.unpacked(packed.as_py())
                held.append((part.layers(), part.words))
                size += sum(len(layer[0]) for layer in held[-1][0])
                if size >= 2 * merged + HELD:
                    held = [added(held)]
                    size = merged = sum(len(layer[0]) for layer in held[0][0])
        if held:
            yield done()

    return parts.repartition("range").sortWithinPartitions("range").mapInArrow(run, "range int, automaton binary")


def phrases(automata: DataFrame, least: int) -> DataFrame:
    """``(lang, words array<string>, a)``: the sequences of two words and more that occur ``least`` times."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("a", pa.int64())])

    def run(batches):
        for batch in batches:
            for packed in batch.column(0):
                own = Automaton.unpacked(packed.as_py())
                names = own.words.cast(pa.string())
                path: list[np.ndarray] = []
                for depth, (parent, symbol, weight) in enumerate(own.layers()):
                    path = [p[parent] for p in path] + [symbol]
                    often = np.flatnonzero(weight >= least)
                    if depth < 2 or not len(often):
                        continue
                    flat = np.stack([p[often] for p in path[1:]], axis=1).ravel()
                    offsets = pa.array(np.arange(len(often) + 1, dtype=np.int32) * depth)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(path[0][often])), pa.ListArray.from_arrays(offsets, names.take(pa.array(flat))),
                         pa.array(weight[often])], schema=schema)

    return automata.select("automaton").mapInArrow(run, "lang string, words array<string>, a bigint")


def looked_up(automata: DataFrame, parts: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """``(lang, part, count)`` for each of the distinct ``parts(lang, part array<string>)``."""
    def place(batches):
        for batch in batches:
            ranges = [bisect_right(bounds, (lang, *part)) for lang, part in zip(*as_bytes(batch, 0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), *batch.columns], names=["range", "lang", "part"])

    def compose(own: pa.Table, counts: pa.Table) -> pa.Table:
        found = np.zeros(own.num_rows, dtype=np.int64)
        if own.num_rows and counts.num_rows:
            rows = [(lang, *part) for lang, part in zip(*as_bytes(own, 1, 2))]
            order = sorted(range(len(rows)), key=rows.__getitem__)
            found[order] = composed([rows[i] for i in order], Automaton.unpacked(counts.column(1)[0].as_py()))
        return pa.table({"lang": own.column(1), "part": own.column(2), "count": pa.array(found)})

    asked = parts.mapInArrow(place, "range int, lang string, part array<string>")
    return asked.groupBy("range").cogroup(automata.groupBy("range")).applyInArrow(compose, "lang string, part array<string>, count bigint")


def as_bytes(held, lang: int, part: int) -> tuple[list, list]:
    return (held.column(lang).cast(pa.binary()).to_pylist(), held.column(part).cast(pa.list_(pa.binary())).to_pylist())


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(UNIT * a * a / (left * right)) in whole numbers of 38 digits."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    over = (wide[0] * wide[0] * F.lit(UNIT).cast("decimal(7,0)")).cast("decimal(38,0)")
    # the quotient of whole numbers, not of rounded ones
    return F.call_function("div", over, (wide[1] * wide[2]).cast("decimal(38,0)"))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, per_cent: int = PER_CENT,
         best: int = BEST, block_bytes: int = BLOCK_BYTES, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``best`` phrases of 2 to ``longest`` words of each language.

    A phrase occurs ``a`` times and at least ``least`` times within pieces of text; ``l`` and ``r`` are the counts of the two parts
    of its lowest-scoring cut, ``n`` all words of the language. Phrases inside a longer one that has ``per_cent`` of their
    count go. Order: score and ``a`` falling, then the phrase by its bytes. Null and empty texts have no words, a null
    language is ``und``, repeated rows count as often as they occur. No candidates give no rows. Counts may have 15 digits.
    """
    rows = texts_by_language(docs, lang_col, text_col)
    bounds = bounds_of(rows, longest, block_bytes, range_chars)
    with settings(docs.sparkSession, TOGETHER):
        automata = write_once(union(shards(rows, bounds, longest, block_bytes), least), "phrase-automata")
        found = write_once(phrases(automata, least), "phrases")
        parted = found.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
            "lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"),
            F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
        asked = parted.select("lang", F.explode(F.array("left", "right", F.array().cast("array<string>"))).alias("part")).distinct()
        counts = write_once(looked_up(automata, asked, bounds), "counts-of-parts")
    side = counts.filter(F.size("part") > 0)
    cut = parted.join(side.select("lang", F.col("part").alias("left"), F.col("count").alias("l")), ["lang", "left"]).join(
        side.select("lang", F.col("part").alias("right"), F.col("count").alias("r")), ["lang", "right"])
    lowest = cut.groupBy("lang", "words", "a").agg(F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))
    # the greatest count of a longer candidate that a phrase lies in
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.slice("words", i, n))))
    around = found.filter(F.size("words") > 2).select("lang", "a", F.explode(inner).alias("words")).groupBy("lang", "words").agg(F.max("a").alias("around"))
    held = lowest.join(around, ["lang", "words"], "left").filter(F.coalesce(100 * F.col("around") < per_cent * F.col("a"), F.lit(True)))
    total = counts.filter(F.size("part") == 0).select("lang", F.col("count").alias("n"))
    scored = held.join(total, "lang").select("lang", F.array_join("words", " ").alias("phrase"), "a", F.col("cut.l").alias("l"),
                                             F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of shares of a language first, so that the task that ranks it gets a bounded number of rows
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    shared = Window.partitionBy("lang", "share").orderBy(*order)
    some = scored.withColumn("share", share).withColumn("rank", F.row_number().over(shared)).filter(F.col("rank") <= best)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
