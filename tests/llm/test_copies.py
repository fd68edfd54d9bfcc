"""SimHash classes, Golay codes and components against brute force."""

import random
import re
from itertools import combinations

import duckdb
import numpy as np
import xxhash

from scholarmill.llm import golay, simhash
from scholarmill.llm.components import components


def test_every_vector_is_near_one_codeword():
    words = np.arange(1 << 12) << 11
    own = np.array([int(w) ^ golay.remainder(int(w)) for w in words])
    assert all(golay.remainder(int(w)) == 0 for w in own)
    assert min(int(w).bit_count() for w in own if w) == 7
    draw = np.random.default_rng(1).integers(0, 1 << 23, 400)
    for v, near in zip(draw, golay.indices(draw)):
        apart = np.bitwise_count(own ^ v)
        least = apart.min()
        expected = {int(i) for i in np.flatnonzero(apart <= (4 if least == 3 else least))}
        assert {int(x) for x in near if x >= 0} == expected and len(expected) in (1, 6)


def test_one_error_shares_an_index():
    draw = np.random.default_rng(2).integers(0, 1 << 23, 2000)
    for bit in range(23):
        for a, b in zip(golay.indices(draw), golay.indices(draw ^ (1 << bit))):
            assert set(a[a >= 0]) & set(b[b >= 0])


def roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 560)] + [(559, 700), (7, 7), (700, 559)]
    edges += [(draw.randint(1000, 1400), draw.randint(1000, 1400)) for _ in range(250)]
    frame = spark.createDataFrame([*edges, (None, 3), (4, None), edges[0]], "a long, b long")
    linked = [(a, b) for a, b in edges if a != b]
    expected = roots({x for e in linked for x in e}, linked)
    assert {r.id: r.component_id for r in components(frame).collect()} == expected
    assert components(frame.filter("a = 7")).count() == 0


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(keys, texts):
    prints = [brute_fingerprint(t) for t in texts]
    near = [(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = roots(range(len(texts)), near)
    least = {}
    for i, k in enumerate(keys):
        least[root[i]] = min(least.get(root[i], k), k)
    return {k: (f"{prints[i]:016x}", least[root[i]]) for i, k in enumerate(keys)}


def corpus():
    texts = [t for t, in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()]
    draw = random.Random(8)
    long = texts[0].split()
    for _ in range(60):  # a crowd of copies with one word changed
        words = list(long)
        words[draw.randrange(len(words))] = draw.choice(["x", "y", "zzz"])
        texts.append(" ".join(words))
    return [*texts, None, "", " \t\n", "one", "ONE two", "\x1cé\x85Ä É", texts[3], texts[3].upper()]


def test_classes_equal_brute_force(spark):
    texts = corpus()
    keys = [2 * i + 1 for i in range(len(texts))]
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in zip(keys, texts)], "doc_id long, text string, fp string, key int")
    expected = brute_classes(keys, texts)
    for crowd in (simhash.CROWD, 1, 10_000):
        found = simhash.digests(simhash.classes(docs, crowd=crowd)).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == {k for k, (_, c) in expected.items() if k == c}
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.classes(docs.filter("false")).count() == 0


def test_random_fingerprints(spark):
    draw = random.Random(6)
    own = {draw.getrandbits(64) for _ in range(60)}
    for _ in range(3):
        own |= {x ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for x in list(own)}
    own = sorted(own | {0, 1, 3, (1 << 64) - 1, 1 << 63})
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in own], "fp long")
    expected = roots(own, [(a, b) for a, b in combinations(own, 2) if (a ^ b).bit_count() <= 2])
    for crowd in (simhash.CROWD, 1):
        found = simhash.links(frame, crowd).collect()
        pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
        assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
        assert roots(own, pairs) == expected


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "other words here now")], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.component_id) for r in simhash.classes(docs).collect())
    assert found == [("4", 4), ("4", 4), ("9", 9), ("None", 4)]
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(4, "a b c"), (9, "other words here now")]


def test_an_id_with_two_texts(spark):
    a, b = "first text with some words of its own", "another passage that shares nothing with it"
    docs = spark.createDataFrame([(5, a), (5, b), (1, b), (7, a), (None, b), (8, None), (8, a), (6, "")], "doc_id long, text string")
    kept = sorted(map(str, (tuple(r) for r in simhash.keep_one(docs).collect())))
    assert kept == sorted(map(str, [(5, a), (1, b), (6, "")]))


def test_one_row_of_each_class_whatever_its_columns(spark):
    """Ids without a class of their own, repeated rows, and columns named like those of the operator."""
    a, b, c = "first text with some words of its own", "another passage that shares nothing with it", "a third one, which has no id at all here"
    rows = [(3, a, 1), (3, a, 1), (3, a, 2), (2, b, 5), (2, b, 4), (None, a, 0), (None, c, 7), (None, c, 7), (None, c, 6), (9, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").selectExpr(
        "*", "1 AS _drop", "2 AS _print", "3 AS _fp", "4 AS _id", "5 AS _mark", "6 AS mark", "7 AS fp", "map('k', n) AS held", "n AS `a.b`").repartition(4)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted([("3", a), ("2", b), ("None", c), ("9", None)], key=str)
    assert all(r.held == {"k": r.n} and r["a.b"] == r.n and r._drop == 1 for r in found)
    same = {r.text: r.n for r in simhash.keep_one(docs.repartition(1)).collect()}
    assert same == {r.text: r.n for r in found}
