import datetime as dt
import os
import re
import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from scholarmill.operators.horizon import citation_horizon
from scholarmill.plans.streams import SLICES, landed_documents, stream_ingest
from scholarmill.session import fresh_path, settings
from scholarmill.sources.keyed_store import KeyedStore
from scholarmill.streaming.horizon import compact_counts, daily_counts, running_horizon, start_counts
from scholarmill.streaming.ingest import start_ingest
from scholarmill.streaming.keyed_horizon import GROUPS, SALTS, PaperCounts, paper_counts, start_paper_counts, stored_horizon


def landed(df, path, files):
    df.repartition(files).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest_over_several_batches_and_a_second_source(spark):
    rows = spark.range(60).select((F.col("id") % 20).cast("string").alias("k"), (F.col("id") % 20).alias("v"),
                                  F.col("id").alias("seq"))
    stream = landed(rows, fresh_path(spark, "incoming"), 3)
    store = KeyedStore(spark, fresh_path(spark, "store"), "k", rows.drop("seq").schema, buckets=4)
    for name in ("a", "b"):
        start_ingest(stream, store, fresh_path(spark, name), "seq").awaitTermination()
    stored = store.rows()
    assert stored.count() == 20 and stored.where("cast(v as string) <> k").count() == 0


def test_documents_land_as_they_lie(spark, tmp_path):
    """In slices, each of rows from every split of the table: no task gathers a slice's texts."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 300).alias("text"))
    rows.repartition(10).write.parquet(str(tmp_path / "documents.parquet"))
    landed = []
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "2000"}):
        stream = landed_documents(spark, str(tmp_path), lambda stream: landed.append(stream))
        query = stream.writeStream.format("memory").queryName("landed_rows").trigger(availableNow=True).start()
        query.awaitTermination()
    assert len(landed) == SLICES and sorted(r["doc_id"] for r in spark.table("landed_rows").collect()) == list(range(400))
    path = spark.read.format("parquet").load(landed_path(query)).withColumn("file", F.input_file_name())
    assert path.groupBy("file").count().agg(F.max("count")).first()[0] <= 40 < 400 // SLICES
    assert stream_ingest(spark, str(tmp_path)).count() == 300


def test_running_counts_equal_the_batch_counts(spark):
    start = dt.date(2020, 1, 1)
    papers = spark.createDataFrame([(i, start + dt.timedelta(days=10 * i)) for i in range(5)], "paper_id long, submitted date")
    events = spark.range(200).select(
        "id", (F.col("id") % 4).alias("paper_id"),
        F.expr("timestamp '2019-12-01 12:00:00' + make_interval(0, 0, 0, cast(id * 5 as int))").alias("cited_at"))
    stream = landed(events.unionByName(events.where("id % 7 = 0")), fresh_path(spark, "events"), 4)
    path = fresh_path(spark, "counts")
    start_counts(daily_counts(stream, ["id"], "4000 days"), path, fresh_path(spark, "ck")).awaitTermination()
    batch = citation_horizon(papers, events.select("paper_id", F.to_date("cited_at").alias("cited_on")))
    got, want = (sorted(map(tuple, df.collect())) for df in (running_horizon(papers, path), batch))
    assert got == want and got[4][2:] == (0, 0)


def slices_of(spark, days, papers, repeats=3):
    """Events of one day after the other, as files that land in that order."""
    path = fresh_path(spark, "slices")
    for i, day in enumerate(days):
        rows = [(100 * i + p, p, dt.datetime.combine(day, dt.time(12))) for p in papers]
        frame = spark.createDataFrame(rows * repeats, "id long, paper_id long, cited_at timestamp")
        frame.coalesce(1).write.mode("append").parquet(path)
        yield spark.readStream.schema(frame.schema).parquet(path)


def landed_path(query):
    return re.search(r"FileStreamSource\[(.*)\]", query.lastProgress["sources"][0]["description"]).group(1)


def total_rows(query):
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]


def test_days_that_are_over_leave_the_state(spark):
    """The state holds the days of the lateness, not those of the stream, and the counts stay those of the batch."""
    start, path, checkpoint, seen = dt.date(2020, 1, 1), fresh_path(spark, "counts"), fresh_path(spark, "ck"), []
    days = [start + dt.timedelta(days=20 * i) for i in range(4)]
    for stream in slices_of(spark, days, range(5)):
        run = start_counts(daily_counts(stream, ["id"], "10 days"), path, checkpoint)
        run.awaitTermination()
        seen.append(total_rows(run)[-1])
    # a day's five events and five counts, and those of the day before while the watermark is behind
    assert max(seen) <= 20 and seen[-1] <= seen[1]
    papers = spark.createDataFrame([(p, start) for p in range(7)], "paper_id long, submitted date")
    counted = {r["paper_id"]: r["citations_12mo"] for r in running_horizon(papers, path).collect()}
    assert counted == {**dict.fromkeys(range(5), 4), 5: 0, 6: 0}


def test_repeats_on_a_day_need_no_entry_per_event(spark):
    """A key with paper and time: one state operator, an entry per paper and day, and repeats of later batches count once."""
    start, path, checkpoint = dt.date(2020, 1, 1), fresh_path(spark, "counts"), fresh_path(spark, "ck")
    incoming = fresh_path(spark, "repeated")
    for i in range(3):
        # two events each at noon and one at six; one of the first batch comes again in every batch, null line and all
        rows = [(n, None if n == 0 else n, p, dt.datetime.combine(start + dt.timedelta(days=d), dt.time(hour)))
                for p in range(4) for d in {0, i} for n, hour in ((0, 12), (1, 12), (1, 18))]
        frame = spark.createDataFrame(rows * 2, "id long, line long, paper_id long, cited_at timestamp")
        frame.repartition(3).write.mode("append").parquet(incoming)
        run = start_counts(daily_counts(spark.readStream.schema(frame.schema).parquet(incoming), ["id", "line", "paper_id", "cited_at"], "30 days"), path, checkpoint)
        run.awaitTermination()
        assert [len(p["stateOperators"]) for p in run.recentProgress if p["stateOperators"]] == [1] * len(run.recentProgress)
        assert total_rows(run)[-1] == 4 * (i + 1)
    assert {(r["paper_id"], r["cited_on"]): r["n_events"] for r in compact_counts(spark, path).collect()} == {
        (p, start + dt.timedelta(days=d)): 3 for p in range(4) for d in range(3)}


def test_compaction_is_kept(spark, tmp_path):
    rows = "paper_id long, started timestamp, cited_on date, n_events long"
    noon, path = dt.datetime(2020, 1, 1), str(tmp_path / "counts")

    def batch(number, own):
        spark.createDataFrame([(p, noon, noon.date(), n) for p, n in own], rows).write.parquet(f"{path}/batch={number}")

    def counts():
        return {r["paper_id"]: r["n_events"] for r in compact_counts(spark, path).collect()}

    batch(0, [(1, 2), (2, 5)])
    assert counts() == {1: 2, 2: 5}
    # what is compacted is not read again
    import shutil
    shutil.move(f"{path}/batch=0", str(tmp_path / "gone"))
    batch(1, [(1, 7)])
    batch(2, [(3, 1)])
    assert counts() == {1: 7, 2: 5, 3: 1}
    assert counts() == {1: 7, 2: 5, 3: 1} and sorted(p.name for p in (tmp_path / "counts-compacted").iterdir()) == ["upto=0", "upto=2"]


def test_a_timer_ends_the_entries_of_a_paper(spark):
    start, path, checkpoint = dt.date(2020, 1, 1), fresh_path(spark, "paper-counts"), fresh_path(spark, "ck")
    papers = spark.createDataFrame([(p, start + dt.timedelta(days=100 * p)) for p in range(3)], "paper_id long, submitted date")
    days = [start + dt.timedelta(days=i) for i in (0, 200, 600, 1000, 1400)]
    seen, events = [], []
    for i, stream in enumerate(slices_of(spark, days, range(3))):
        run = start_paper_counts(paper_counts(stream, papers, ["id"], "5 days", salts=2), path, checkpoint)
        run.awaitTermination()
        entries = [op["numRowsTotal"] for p in run.recentProgress for op in p["stateOperators"] if op["operatorName"] == "transformWithStateInPandasExec"]
        seen.append(entries[-1])
        events += [(p, days[i]) for p in range(3)]
    batch = citation_horizon(papers, spark.createDataFrame(events, "paper_id long, cited_on date"))
    got = {r["paper_id"]: r for r in stored_horizon(papers, path).collect()}
    want = {r["paper_id"]: (r["citations_12mo"], r["citations_24mo"]) for r in batch.collect()}
    assert {p: (r["citations_12mo"], r["citations_24mo"]) for p, r in got.items()} == want
    # two years after the last paper nothing is left of any
    assert all(r["final"] for r in got.values())
    assert max(seen) > 0 and seen[-1] == 0


def test_events_of_a_hot_paper_are_dealt_over_entries(spark):
    start, path = dt.date(2020, 1, 1), fresh_path(spark, "paper-counts")
    papers = spark.createDataFrame([(1, start), (2, start)], "paper_id long, submitted date")
    events = spark.range(400).select("id", F.when(F.col("id") < 390, 1).otherwise(2).alias("paper_id"),
                                     F.lit(dt.datetime(2020, 3, 1, 12)).alias("cited_at"))
    start_paper_counts(paper_counts(landed(events, fresh_path(spark, "events"), 2), papers, ["id"], "5 days"), path, fresh_path(spark, "ck")).awaitTermination()
    assert spark.read.parquet(path).where("paper_id = 1").select("salt").distinct().count() == SALTS
    assert {r["paper_id"]: r["citations_24mo"] for r in stored_horizon(papers, path).collect()} == {1: 390, 2: 10}


def rows_of(query, operator):
    return [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"] == operator]


def test_entries_of_many_papers_share_calls_of_the_state(spark):
    """Entries lie in groups, so the state's rows, and with them its calls, are not as many as the papers."""
    start, path, many = dt.date(2020, 1, 1), fresh_path(spark, "many"), 6000
    papers = spark.range(many).select(F.col("id").alias("paper_id"), F.date_add(F.lit(start), (F.col("id") % 3).cast("int")).alias("submitted"))
    events = spark.range(2 * many).select("id", (F.col("id") % many).alias("paper_id"), F.lit(dt.datetime(2020, 3, 1, 12)).alias("cited_at"))
    run = start_paper_counts(paper_counts(landed(events, fresh_path(spark, "events"), 2), papers, ["id"], "5 days", salts=1), path, fresh_path(spark, "ck"))
    run.awaitTermination()
    # a value and a timer, which has two rows, for each group
    assert 0 < max(rows_of(run, "transformWithStateInPandasExec")) <= 3 * GROUPS < many
    assert stored_horizon(papers, path).where("citations_12mo = 2 and citations_24mo = 2 and not final").count() == many


def test_repeats_and_papers_listed_twice_in_keyed_counts(spark):
    """Events outside the horizon stay out of all state, repeats count once, and an event once for each row of its paper."""
    start, path, checkpoint, incoming = dt.date(2020, 1, 1), fresh_path(spark, "paper-counts"), fresh_path(spark, "ck"), fresh_path(spark, "repeated")
    papers = spark.createDataFrame([(1, start), (2, start), (2, start), (3, start + dt.timedelta(days=355))], "paper_id long, submitted date")
    seen, ended = [], []
    for day in (0, 360, 361, 1106):
        # two lines a paper, one without a number, both twice; those of day 360 come again with day 361's
        again = {361: (361, 360)}.get(day, (day,))
        rows = [(line, p, dt.datetime.combine(start + dt.timedelta(days=d), dt.time())) for p in (1, 2, 3, 4) for d in again for line in (None, 1)]
        frame = spark.createDataFrame(rows * 2, "line long, paper_id long, cited_at timestamp")
        frame.repartition(3).write.mode("append").parquet(incoming)
        run = start_paper_counts(paper_counts(spark.readStream.schema(frame.schema).parquet(incoming), papers, ["line", "paper_id", "cited_at"], "30 days"), path, checkpoint)
        run.awaitTermination()
        seen.append(max(rows_of(run, "dedupeWithinWatermark")))
        ended.append({r["paper_id"] for r in stored_horizon(papers, path).where("final").collect()})
    got = sorted((r["paper_id"], r["citations_12mo"], r["citations_24mo"]) for r in stored_horizon(papers, path).collect())
    assert got == [(1, 4, 6), (2, 8, 12), (2, 8, 12), (3, 4, 4)]
    # paper 4 is unknown and day 1106 outside, so at most days 360 and 361 of three papers are there at once
    assert seen[0] == 4 and max(seen) <= 12
    # paper 3's time is over on day 1076, which the watermark has just reached
    assert ended == [set(), set(), set(), {1, 2, 3}]


def test_keyed_counts_need_neither_the_package_nor_a_set_state_store(spark, tmp_path):
    # the process beside the driver starts in another folder and without the package
    dumped = tmp_path / "processor"
    dumped.write_bytes(cloudpickle.dumps(PaperCounts((360, 720))))
    load = "import sys; from pyspark import cloudpickle; print(cloudpickle.loads(open(sys.argv[1], 'rb').read()).days)"
    known = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", load, str(dumped)], cwd=tmp_path, env=known, capture_output=True, text=True, check=False)
    assert ran.stdout.strip() == "(360, 720)", ran.stderr

    papers = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "paper_id long, submitted date")
    events = spark.range(5).select("id", F.lit(1).cast("long").alias("paper_id"), F.expr("timestamp '2020-03-01 12:00:00'").alias("cited_at"))
    path, store = fresh_path(spark, "keyed"), "spark.sql.streaming.stateStore.providerClass"
    with settings(spark, {store: "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"}):
        counts = paper_counts(landed(events, fresh_path(spark, "keyed-events"), 1), papers, ["id"], "30 days", salts=2)
        start_paper_counts(counts, path, fresh_path(spark, "keyed-ck")).awaitTermination()
    assert [r["citations_12mo"] for r in stored_horizon(papers, path).collect()] == [5]
