"""Suffix sorting and the removal of repeated strings against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmill.llm import repeats
from scholarmill.llm.suffixes import Text, shared_windows

ALPHABETS = (b"ab", b"a", b"abc\x00\xff", bytes(range(256)), b"\x00\x01")


def strings_of(draw, length):
    alphabet = draw.choice(ALPHABETS)
    base = bytes(draw.choice(alphabet) for _ in range(300))
    out = []
    for _ in range(draw.randint(1, 10)):
        n = draw.randint(1, 30)
        at = draw.randint(0, 300 - n - length)
        own = base[at:at + n + length - 1] if draw.random() < 0.7 else bytes(draw.choice(alphabet) for _ in range(n + length - 1))
        out.append((own, n))
    return [s for s, _ in out], np.array([n for _, n in out])


def test_shared_windows_equal_brute_force():
    draw = random.Random(1)
    for _ in range(400):
        length = draw.choice([1, 3, 7, 8, 9, 16, 20, 100])
        strings, starts = strings_of(draw, length)
        seen = {}
        for i, (s, n) in enumerate(zip(strings, starts)):
            for at in range(n):
                seen.setdefault(s[at:at + length], []).append((i, at))
        found = {}
        for c, i, at in zip(*(x.tolist() for x in shared_windows(strings, starts, length))):
            found.setdefault(c, []).append((i, at))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in seen.values() if len(v) > 1)
        text = Text(strings, starts)
        order = [tuple(text.symbol[i:i + length].tolist()) for i in text.order(length).tolist()]
        assert order == sorted(order) and len(order) == starts.sum()


def test_anchors_serve_every_window_once():
    draw = random.Random(2)
    for size in (99, 100, 101, 350, 4000):
        for alphabet in ALPHABETS:
            raw = np.frombuffer(bytes(draw.choice(alphabet) for _ in range(size)), dtype=np.uint8)
            _, first, n = repeats.anchors(raw, 100, 32)
            assert [x for f, k in zip(first, n) for x in range(f, f + k)] == list(range(max(0, size - 99)))


def brute(docs, length):
    """``{doc_id: (n_bytes, n_removed, n_spans, digest)}``, documents in order of their ids."""
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=np.int8)
        for at in range(len(raw) - length + 1):
            window = raw[at:at + length]
            if window in seen:
                gone[at:at + length] = 1
            seen.add(window)
        spans = int((np.diff(np.append(0, gone)) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[key] = len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()
    return out


def fixture_docs(length):
    draw = random.Random(length)
    base = "".join(draw.choice("abcdé ") for _ in range(900))
    docs = [(7, None), (3, ""), (None, base[:150]), (11, "short"), (12, "x" * 700), (13, "y" + "x" * 300), (14, "ab" * 400)]
    for i in range(50):
        a = draw.randint(0, 700)
        middle = base[a:a + draw.randint(50, 200)]
        docs.append((20 + i, "".join(draw.choice("pqrs") for _ in range(draw.randint(0, 90))) + middle + "".join(draw.choice("tuv") for _ in range(draw.randint(0, 90)))))
    docs += [(90, docs[20][1]), (2, docs[21][1]), (91, docs[20][1] * 2), (92, base)]
    return docs


@pytest.mark.parametrize("length,crowd,block", [(100, repeats.CROWD, repeats.BLOCK_BYTES), (100, 1, 500), (100, 3, 500), (64, 2, 2000)])
def test_removal_equals_brute_force(spark, monkeypatch, length, crowd, block):
    monkeypatch.setattr(repeats, "PIECE", 256)
    docs = fixture_docs(length)
    frame = spark.createDataFrame([(k, t, 1, "clash") for k, t in docs], "doc_id long, text string, row int, first string").repartition(5)
    found = repeats.digests(repeats.remove(frame, length=length, crowd=crowd, block_bytes=block)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute(docs, length)
    assert len(found) == len(docs)


def test_documents_and_empty_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    found = repeats.digests(repeats.remove(frame)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute(docs, 100)
    assert repeats.remove(frame.filter("false")).count() == 0


def test_changed_splits_and_order_change_nothing(spark, monkeypatch, tmp_path):
    """Files are split anew for every step, and rows come in another order, as when executors come and go."""
    docs = fixture_docs(100)
    frame = spark.createDataFrame([(k, t) for k, t in docs], "doc_id long, text string")
    frame.repartition(16).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    sizes, kept = iter([2048, 1 << 27, 5000, 900, 1 << 20] * 9), repeats.write_once

    def elsewhere(*args, **kw):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(next(sizes)))
        spark.conf.set("spark.sql.files.openCostInBytes", str(next(sizes)))
        return kept(*args, **kw)

    monkeypatch.setattr(repeats, "write_once", elsewhere)
    try:
        for rows in (spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "t")).orderBy(F.rand())):
            found = repeats.digests(repeats.remove(rows, crowd=3)).collect()
            assert {r.doc_id: tuple(r)[1:] for r in found} == brute(docs, 100) and len(found) == len(docs)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_ids(spark):
    draw = random.Random(3)
    text = "".join(draw.choice("abcdef ") for _ in range(250))
    frame = spark.createDataFrame([(5, text), (5, text), (5, text), (5, "tiny"), (5, "tiny"), (None, text[:120])], "doc_id long, text string").coalesce(1)
    found = sorted(repeats.digests(repeats.remove(frame)).collect(), key=lambda r: (str(r.doc_id), r.n_removed))
    assert [(r.doc_id, r.n_removed) for r in found] == [(5, 0), (5, 0), (5, 120), (5, 250), (5, 250), (None, 0)]
