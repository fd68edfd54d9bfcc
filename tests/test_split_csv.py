"""CSV files of several splits against a reader that goes through them from their start."""

import csv
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scholarmill.sources.schemas import UPLOAD
from scholarmill.sources.split_csv import BEGIN, CHARACTERS_TOGETHER, WHOLE, cutter, read_split_csv, records
from scholarmill.sources.tables import read_upload, write_csv


def written(path, rows, end="\n", header=("title", "abstract")):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([header, *rows])


def cells(seed, n, longest=40):
    draw = random.Random(seed)
    parts = ["a", "b c", ",", '"', '""', "\n", "\n\n", "é😀", '",\n"', "x" * 30, "\t"]
    return [tuple("".join(draw.choice(parts) for _ in range(draw.randint(1, longest))).strip() or "z" for _ in range(2)) for _ in range(n)]


@pytest.mark.parametrize("size", [64, 257, 1000, 1 << 20])
def test_any_split_gives_the_same_rows(spark, tmp_path, size):
    """Cells of quotes, separators and line breaks; records that cross one split and many; several files."""
    folder = tmp_path / "upload"
    folder.mkdir()
    rows = []
    for i, n in enumerate((60, 1, 25)):
        own = cells(i, n) + ([("long", "line\n" * 400 + '"quoted"')] if i == 0 else [])
        written(folder / f"part{i}.csv", own)
        rows += own
    (folder / "empty.csv").write_text("")
    (folder / "header.csv").write_text("title,abstract\n")
    found = read_split_csv(spark, str(folder), UPLOAD, size)
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_line_ends_of_both_kinds_and_blank_lines(spark, tmp_path):
    written(tmp_path / "dos.csv", [("a", "b\r\nc"), ("d", "e")], end="\r\n")
    assert sorted(map(tuple, read_split_csv(spark, str(tmp_path / "dos.csv"), UPLOAD, 16).collect())) == [("a", "b\nc"), ("d", "e")]
    (tmp_path / "blank.csv").write_text('title,abstract\n\na,b\n\n\n"c\n\nd",e\n')
    assert sorted(map(tuple, read_split_csv(spark, str(tmp_path / "blank.csv"), UPLOAD, 8).collect())) == [("a", "b"), ("c\n\nd", "e")]


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rows = cells(7, 400, 60)
    written(tmp_path / "one.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = records(spark, str(tmp_path / "one.csv"), 4096)
    assert lines.count() == 400 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    status = spark.sparkContext.statusTracker()
    group = "csv-splits"
    spark.sparkContext.setJobGroup(group, "")
    read_split_csv(spark, str(tmp_path / "one.csv"), UPLOAD, 4096)
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    assert max(tasks) >= (tmp_path / "one.csv").stat().st_size // 4096


def test_uploads_that_spark_wrote(spark, tmp_path):
    rows = [("t\n1", 'a "quoted", b'), (None, "only"), ("x", None), ("", "\n"), ("é", " pad ")]
    write_csv(spark.createDataFrame(rows, "title string, abstract string").repartition(2), str(tmp_path / "out"))
    plain = spark.read.schema(UPLOAD).options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "out"))
    expected = plain.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in UPLOAD.fieldNames()))
    assert sorted(map(tuple, read_upload(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, expected.collect()))


def test_long_records_leave_a_task_a_few_at_a_time():
    """What is held follows the characters and not the number of records; all of them come out, the open one too."""
    lines = [f"{i}," + "x" * 50_000 for i in range(300)] + ['open,"goes on']
    batch = pa.RecordBatch.from_pydict({"split": [7] * len(lines), "line": lines})
    found = list(cutter(frozenset(), frozenset([7]))([batch]))
    assert max(sum(map(len, b.column(3).to_pylist())) for b in found) <= CHARACTERS_TOGETHER + 60_000
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert rows == [(7, WHOLE, i == 0, line) for i, line in enumerate(lines[:-1])] + [(7, BEGIN, False, lines[-1])]
