"""Exact copies by streaming state against brute force."""

import hashlib
import random
import re

import pytest

from scholarmill.llm import exactdup


def brute(rows):
    """Rows (doc_id, text) in file order to (doc_id, keep_id, group_size, kept, sha256), sorted."""
    groups = {}
    for place, (key, text) in enumerate(rows):
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), key is None, key or 0, place))
    out = []
    for body, members in groups.items():
        least = min(members)
        keep = None if least[1] else least[2]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(None if no_id else key, keep, len(members), m == least, sha) for m in members for _, no_id, key, _ in [m]]
    return sorted(out, key=repr)


def stored(spark, folder, rows, files=1, extra=False):
    """Files named so that their order is that of the rows."""
    step = -(-len(rows) // files) or 1
    for i in range(files):
        frame = spark.createDataFrame([(k, t) for k, t in rows[i * step:(i + 1) * step]], "doc_id long, text string")
        if extra:
            frame = frame.selectExpr("doc_id", "text", "1 AS key", "'x' AS `at`", "2 AS _metadata", "3 AS stays", "4L AS n", "'y' AS body")
        frame.coalesce(1).write.mode("append").parquet(str(folder))


def decided(own, **kw):
    return sorted(map(tuple, exactdup.digests(exactdup.decide(own, **kw)).collect()), key=repr)


def made(n, seed):
    draw = random.Random(seed)
    bodies = ["a b", "ab", "a\tb\n", "", None, " \x0b\x0c\r", "ünï cödé", "ünï cödé", "x" * 70_000, "same text again"]
    return [(draw.randint(0, n), draw.choice(bodies) if draw.random() < .8 else f"own {i}") for i in range(n)]


@pytest.mark.parametrize("key_bytes", [32, 1])
def test_equals_brute_force_over_micro_batches(spark, tmp_path, key_bytes):
    """A key of one byte makes different texts share one: their bytes must tell them apart."""
    rows = [(i, t) for i, (_, t) in enumerate(made(300, 3))] + [(None, "ab"), (None, "nobody's"), (None, "nobody's ")]
    stored(spark, tmp_path / "t", rows, files=4, extra=True)
    own = exactdup.intake(spark, str(tmp_path / "t"), key_bytes=key_bytes).read_on(files_per_batch=1)
    assert decided(own, together=7) == brute(rows)


def test_state_outlives_a_run(spark, tmp_path):
    first, later = [(5, "a b c"), (6, "other"), (7, "a bc")], [(1, "abc"), (2, "other one"), (3, "abc  "), (4, "other")]
    stored(spark, tmp_path / "t", first)
    home = str(tmp_path / "home")
    own = exactdup.intake(spark, str(tmp_path / "t"), home).read_on()
    assert decided(own) == brute(first)
    stored(spark, tmp_path / "t", later)
    again = exactdup.intake(spark, str(tmp_path / "t"), home).read_on()
    assert decided(again) == brute(first + later)
    # nothing new: nothing is read twice
    assert decided(exactdup.intake(spark, str(tmp_path / "t"), home).read_on()) == brute(first + later)
    assert again.state().count() == len({s for *_, s in brute(first + later)})


def test_wholly_repeated_rows_keep_one(spark, tmp_path):
    stored(spark, tmp_path / "t", [(9, "copy")] * 50 + [(8, "c o p y")])
    out = decided(exactdup.intake(spark, str(tmp_path / "t")).read_on())
    assert sum(kept for *_, kept, _ in out) == 1 and {(k, n) for _, k, n, _, _ in out} == {(8, 51)}
    stored(spark, tmp_path / "u", [(9, "copy")] * 50)
    out = decided(exactdup.intake(spark, str(tmp_path / "u")).read_on())
    assert [r[3] for r in out].count(True) == 1


def test_single_file_and_empty_table(spark, tmp_path):
    stored(spark, tmp_path / "t", [(1, "one"), (2, "o n e")])
    file = next((tmp_path / "t").glob("part-*.parquet"))
    assert decided(exactdup.intake(spark, str(file)).read_on()) == brute([(1, "one"), (2, "o n e")])
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none"))
    assert decided(exactdup.intake(spark, str(tmp_path / "none")).read_on()) == []


def test_settings_are_left_as_they_were(spark, tmp_path):
    from scholarmill.session import settings

    with pytest.raises(ZeroDivisionError), settings(spark, {"spark.sql.shuffle.partitions": "3", "spark.some.key": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get("spark.some.key", None) is None
