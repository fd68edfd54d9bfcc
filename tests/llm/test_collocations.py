"""Weighted automata and phrases against brute force."""

import random
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa

from scholarmill.llm import automata, collocations


def layered(counts):
    """Sorted layers of sequences with counts, and their words."""
    sequences = sorted({s[:k] for s in counts for k in range(1, len(s) + 1)})
    layers, words, depths, places = automata.accepting(sequences)
    for sequence, depth, place in zip(sequences, depths, places):
        layers[depth][2][place] = counts.get(sequence, 0)
    return layers, pa.array(words, pa.binary())


def accepted(automaton):
    words, out, before = automaton.words.to_pylist(), {}, [()]
    for parent, symbol, weight in automaton.layers():
        before = [before[p] + (words[s],) for p, s in zip(parent, symbol)]
        assert before == sorted(before)
        out.update((s, int(w)) for s, w in zip(before, weight) if w)
    return out


def test_automata_equal_dictionaries():
    draw = random.Random(1)
    alphabet = [b"a", b"b", b"cc", b"\xff", b"z", b""]
    for _ in range(150):
        several = [{tuple(draw.choices(alphabet, k=draw.randint(1, 4))): draw.randint(1, 1 << 40) for _ in range(draw.randint(0, 60))}
                   for _ in range(3)]
        own = [automata.built(*layered(c)) for c in several]
        assert [accepted(a) for a in own] == several
        assert [accepted(automata.Automaton.unpacked(a.packed())) for a in own] == several
        total = Counter()
        for c in several:
            total.update(c)
        every = automata.united(own)
        assert accepted(every) == total
        assert accepted(automata.at_least(every.layers(), every.words, 1 << 39)) == {s: n for s, n in total.items() if n >= 1 << 39}
        bounds = sorted({tuple(draw.choices([*alphabet, b"q"], k=draw.randint(1, 4))) for _ in range(draw.randint(0, 5))})
        for c in several:
            found = {}
            for number, part in automata.ranged(*layered(c), bounds):
                assert {bisect_right(bounds, s) for s in accepted(part)} <= {number}
                found.update(accepted(part))
            assert found == c
        asked = sorted({tuple(draw.choices([*alphabet, b"q"], k=draw.randint(1, 5))) for _ in range(30)})
        assert automata.composed(asked, every).tolist() == [total.get(s, 0) for s in asked]


def test_equal_continuations_share_a_state():
    counts = {(bytes([65 + i]), b"x", b"y"): 1 for i in range(20)}
    assert len(automata.built(*layered(counts)).first) - 1 == 4


def brute(rows, longest=3, least=10, per_cent=50, best=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i:i + k])
                    f[key] = f.get(key, 0) + 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    held = {}
    for (lang, words), a in candidates.items():
        inside = [b for (other, longer), b in candidates.items() if other == lang and len(longer) > len(words) and any(
            longer[i:i + len(words)] == words for i in range(len(longer)))]
        if any(100 * b >= per_cent * a for b in inside):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        low, k = min(cuts)
        held.setdefault(lang, []).append((-low, -a, " ".join(words).encode(), a, f[lang, words[:k]], f[lang, words[k:]], low))
    return sorted((lang, rank, phrase.decode(), a, left, right, n[lang], low) for lang, own in held.items()
                  for rank, (_, _, phrase, a, left, right, low) in enumerate(sorted(own)[:best], 1))


def texts(seed, n=150):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "Éa", "\x1cq", "x" * 300, "b-c", "naïve", " ", "|"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]
    out = [(draw.choice(["en", "en", "fr", None, "und"]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))) for _ in range(n)]
    return [*out, ("en", None), (None, ""), ("xx", " .,; "), ("yy", "once only"), ("long", "to be or not " * 900)]


def test_equals_brute_force(spark):
    rows = texts(2)
    frame = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string").selectExpr(
        "*", "1 AS range", "2 AS automaton", "3 AS words", "4 AS a", "5 AS n").repartition(5)
    expected = brute(rows)
    assert len(expected) > 50
    whole = collocations.mine(frame)
    assert sorted(map(tuple, whole.collect())) == expected
    assert whole.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    # blocks that cut texts within pieces, and many ranges
    small = collocations.mine(frame, block_bytes=70, range_chars=200, best=7)
    assert sorted(map(tuple, small.collect())) == brute(rows, best=7)


def test_longer_phrases_and_other_shares(spark):
    rows = texts(3, 60)
    frame = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string")
    found = collocations.mine(frame, longest=4, least=5, per_cent=80, block_bytes=500)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 5, 80)


def test_large_counts_stay_exact(spark):
    import pyspark.sql.functions as F

    rows = [(3_000_000_019, 3_000_000_019, 3_000_000_019), (10, 99_999_999_999_999, 7), (999_999_999_999, 999_999_999_999, 1_000_000_000_039)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select(collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in found.collect()] == [1_000_000 * a * a // (left * right) for a, left, right in rows]


def test_slices_cover_every_start_once():
    signs = b"".join(b"w%d%s" % (i, b" \xff"[i % 2:i % 2 + 1] * (1 + i % 3)) for i in range(300))
    for size in (1, 7, 50, 10_000):
        parts = list(collocations.slices(signs, size, 3))
        assert b"".join(p[:limit] for p, limit in parts) == signs
    assert list(collocations.slices(b"", 5, 3)) == []


def test_no_documents(spark):
    frame = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(frame).collect() == []
    assert collocations.mine(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).collect() == []
