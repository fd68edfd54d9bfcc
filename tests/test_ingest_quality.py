import datetime as dt

import pytest
from pyspark.sql import functions as F

from scholarmill.operators import cohort as C
from scholarmill.operators import ingest as I
from scholarmill.operators import quality as Q
from scholarmill.operators.horizon import citation_horizon, cited_within, first_event_horizon
from scholarmill.session import fresh_path
from scholarmill.sources import landed
from scholarmill.sources.keyed_store import KeyedStore
from scholarmill.sources.quarantine import Quarantine, start_admitting
from scholarmill.sources.tables import read_upload


def test_feed_entries(spark, tmp_path):
    (tmp_path / "page.xml").write_text("""<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>page</title>
<entry><id>http://x.org/abs/2301.00001v2</id><title>First &amp; best</title><summary>Text</summary>
<published>2023-01-02T03:04:05Z</published><author><name>Ann</name></author><author><name>Bo</name></author></entry>
<entry><title>no id</title></entry>
<entry><id>http://x.org/abs/hep/abs/77</id></entry></feed>""")
    rows = landed.papers_from_feed(landed.read_feed(spark, str(tmp_path)), F.lit("cs.LG")).orderBy("paper_id").collect()
    assert [tuple(r) for r in rows] == [
        ("2301.00001v2", "First & best", "Text", "Ann, Bo", "cs.LG", "2023-01-02"),
        ("77", "", "", "", "cs.LG", "")]


def test_works_documents(spark):
    docs = spark.createDataFrame([
        ("a", '{"results": [{"cited_by_count": 9, "publication_date": "2020-01-05"}, {"cited_by_count": 1}]}'),
        ("b", '{"results": []}'), ("c", "{}"), ("d", '{"results": [{"cited_by_count": 4}]}')], "paper_id string, body string")
    rows = landed.works_from_json(docs, "body").orderBy("paper_id").collect()
    assert [tuple(r) for r in rows] == [("a", 9, "2020-01-05"), ("d", 4, None)]


def test_gate(spark):
    rows = [(7, "2020-12-26", 7), (7, "2020-12-27", 0), (7, None, 7), (7, "not a date", 7), (None, "2020-01-01", 0)]
    df = spark.createDataFrame([(a, b, dt.date(2020, 1, 1), c) for a, b, c in rows], "n long, p string, s date, want int")
    for r in df.select("want", cited_within(F.col("n"), F.col("p"), F.col("s"), 12).alias("got")).collect():
        assert r["got"] == r["want"]


def test_horizon_bounds_and_papers_without_events(spark):
    day = dt.date(2020, 1, 1)
    papers = spark.createDataFrame([(1, day), (2, day)], "paper_id long, submitted date")
    events = spark.createDataFrame([(1, day + dt.timedelta(days=d)) for d in (-1, 0, 0, 360, 361, 720, 721)],
                                   "paper_id long, cited_on date")
    rows = citation_horizon(papers, events).orderBy("paper_id").collect()
    assert [(r["citations_12mo"], r["citations_24mo"]) for r in rows] == [(3, 5), (0, 0)]


def test_first_wins_and_repeats_add_nothing(spark):
    rows = spark.createDataFrame([("a", "late", 3), ("a", "early", 1), ("b", "only", 2)], "k string, v string, seq int")
    store = KeyedStore(spark, fresh_path(spark, "store"), "k", rows.drop("seq").schema, buckets=3)
    assert store.rows().count() == 0
    for _ in range(2):
        store.insert(rows, "seq")
    store.insert(spark.createDataFrame([("a", "other", 0), ("c", "new", 0), (None, "no key", 1)], rows.schema), "seq")
    store.insert(spark.createDataFrame([(None, "again", 0)], rows.schema), "seq")
    stored = {r["k"]: r["v"] for r in store.rows().collect()}
    assert stored == {"a": "early", "b": "only", "c": "new", None: "no key"}
    assert store.rows().count() == 4


def test_a_batch_reads_the_store_in_proportion(spark):
    """New keys open no file of rows, a known key those of its bucket alone; a full filter costs looks, not rows."""
    def rows(keys):
        return spark.createDataFrame([(k, f"v{k}", 1) for k in keys], "k long, v string, seq int")

    store = KeyedStore(spark, fresh_path(spark, "store"), "k", rows([1]).drop("seq").schema, buckets=16, bits=1 << 14)
    for start in range(0, 2000, 500):
        store.insert(rows(range(start, start + 500)), "seq")
    every = len(store.rows().inputFiles())
    assert every == 64 and store.rows().count() == 2000

    def opened(keys):
        batch = rows(keys).withColumn("_bucket", store.bucket()).select("k", "_bucket")
        buckets = [r["_bucket"] for r in store.suspects(batch).select("_bucket").distinct().collect()]
        return len(store.keys_of(buckets).inputFiles()) if buckets else 0

    assert opened(range(5000, 5020)) == 0 and opened([7]) == every // 16 and opened([7, 5001]) == every // 16
    assert opened(range(2000)) == every
    store.insert(rows([7, 5001, 5001]), "seq")
    assert store.rows().count() == 2001
    tiny = KeyedStore(spark, fresh_path(spark, "store"), "k", store.schema, buckets=2, bits=64, probes=1)
    for _ in range(2):
        for start in range(0, 300, 100):
            tiny.insert(rows(range(start, start + 150)), "seq")
    assert tiny.rows().count() == 350 and tiny.rows().distinct().count() == 350


def test_first_row_with_null_order_and_ties(spark):
    rows = spark.createDataFrame([("a", "x", None), ("b", "late", None), ("b", "early", 4), ("c", "p", 1), ("c", "q", 1),
                                  ("c", "q", 1), ("d", None, 2), ("d", "r", 3), (None, "n", 1), (None, "m", 0)],
                                 "k string, v string, seq int").repartition(4)
    got = {r["k"]: (r["v"], r["seq"]) for r in I.first_per_key(rows, "k", "seq").collect()}
    tied = got.pop("c")
    assert got == {"a": ("x", None), "b": ("early", 4), "d": (None, 2), None: ("m", 0)} and tied in (("p", 1), ("q", 1))
    assert I.first_per_key(rows, "k", "seq").count() == 5
    assert I.first_per_key(rows.repartition(2), "k", "seq").where("k = 'c'").first()["v"] == tied[0]
    plan = I.first_per_key(rows, "k", "seq")._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


REQUESTS = "paper_id long, title string, abstract string, authors int, category string"


def requests(spark, rows):
    return spark.createDataFrame(rows, REQUESTS)


def test_valid_and_rejected_rows_are_the_input(spark, tmp_path):
    good, short, many = "a title", "an abstract of some length", 200
    rows = [(1, good, short, 3, None), (2, "x", short, None, "cs.AI"), (3, None, None, many, None), (4, good, short, many, None)]
    kept = Quarantine(spark, str(tmp_path / "requests"), requests(spark, rows).schema, Q.validate_inputs)
    kept.admit(requests(spark, rows), 0)
    kept.admit(requests(spark, rows), 0)  # written again, it replaces itself
    assert {r["paper_id"] for r in kept.valid().collect()} == {1}
    assert {r["paper_id"]: r["violated"] for r in kept.rejected().collect()} == {
        2: ["title_length"], 3: ["title_length", "abstract_length", "author_range"], 4: ["author_range"]}
    assert kept.replay(lambda df: df.withColumn("authors", F.least("authors", F.lit(100)))) == 1
    assert {r["paper_id"]: r["round"] for r in kept.valid().collect()} == {1: 0, 4: 1}
    assert {r["paper_id"]: r["violated"] for r in kept.rejected().collect()} == {2: ["title_length"], 3: ["title_length", "abstract_length"]}
    assert kept.replay(lambda df: df.withColumns({"title": F.lit(good), "abstract": F.coalesce("abstract", F.lit(short))})) == 2
    assert kept.rejected().count() == 0 and sorted(r["paper_id"] for r in kept.valid().collect()) == [1, 2, 3, 4]


def test_a_stream_into_quarantine(spark, tmp_path):
    rows = [(i, "t" * (i % 6), "an abstract of some length", 1, "cs.AI") for i in range(30)]
    frame = requests(spark, rows).repartition(3)
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept = Quarantine(spark, str(tmp_path / "requests"), frame.schema, Q.validate_inputs)
    start_admitting(stream, kept, str(tmp_path / "checkpoint")).awaitTermination()
    valid, rejected = ({r["paper_id"] for r in df.collect()} for df in (kept.valid(), kept.rejected()))
    assert valid == {i for i in range(30) if i % 6 >= 3} and valid | rejected == set(range(30)) and not valid & rejected
    assert kept.rejected().select("round").distinct().count() > 1


def test_report_is_observed_during_the_write(spark, tmp_path, shelf):
    papers, citations = shelf
    some = citations.where("paper_id <> 'p-b'")
    path = str(tmp_path / "ingested")
    report = {r["figure"]: r["value"] for r in Q.write_with_report(papers, some, ["title"], ["citations_12mo", "citations_24mo"], path).collect()}
    separate = {r["column_name"]: r["null_pct"] for r in Q.null_rates(papers, some, ["title"], ["citations_12mo", "citations_24mo"]).collect()}
    assert {k.removeprefix("null_pct."): v for k, v in report.items() if k.startswith("null_pct.")} == separate
    held = Q.coverage(papers, some).first()
    assert (report["total_papers"], report["with_citations"], report["coverage_pct"]) == tuple(held)
    assert spark.read.parquet(path).count() == papers.count()
    empty = {r["figure"]: r["value"] for r in Q.write_with_report(papers.where("false"), some, ["title"], ["citations_12mo"], path).collect()}
    assert empty["total_papers"] == 0 and empty["coverage_pct"] is None and empty["null_pct.title"] is None


def test_a_feed_of_several_splits(spark, tmp_path):
    entries = "".join(f"<entry>\n<id>http://x.org/abs/{i}</id><title>t {i} &lt;entry&gt;</title></entry>\n" for i in range(3000))
    (tmp_path / "big.xml").write_text(f'<?xml version="1.0"?><feed><title>all</title>{entries}</feed>')
    (tmp_path / "empty.xml").write_text("<feed><title>none</title></feed>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows = landed.read_feed(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 4
        assert sorted(r["id"] for r in rows.collect()) == sorted(f"http://x.org/abs/{i}" for i in range(3000))
        assert rows.where("id = 'http://x.org/abs/7'").first()["title"] == "t 7 <entry>"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_horizon_from_the_first_event(spark):
    day = dt.date(2021, 5, 1)
    papers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "paper_id long, category string")
    events = spark.createDataFrame([(p, day + dt.timedelta(days=d)) for p, d in
                                    [(1, 0), (1, 0), (1, 360), (1, 361), (1, 720), (1, 721), (2, 5)]], "paper_id long, cited_on date")
    got = first_event_horizon(papers, events).orderBy("paper_id").collect()
    assert [tuple(r) for r in got] == [(1, "a", day, 3, 5), (2, "b", day + dt.timedelta(days=5), 1, 1)]


def test_cap_counts_over_all_categories(spark):
    d = dt.date
    papers = spark.createDataFrame([("1", "x", d(2020, 1, 2)), ("2", "x", d(2020, 1, 1)), ("3", "y", d(2019, 1, 1)),
                                    ("4", "z", d(2018, 1, 1)), ("5", "x", d(2017, 1, 1))],
                                   "paper_id string, category string, submitted date")
    stored = papers.where("paper_id = '5'")
    got = I.capped_ingest(papers, stored, ["x", "y"], 3).collect()
    assert [r["paper_id"] for r in got] == ["2", "1", "3"]
    assert [r["paper_id"] for r in I.capped_ingest(papers, stored, ["x", "y"], 2).collect()] == ["2", "1"]


def test_record_formats(spark):
    ids = {"1811.07453": True, "0704.00016v13": True, "1811.07453v": False, "181.074533": False, "math.GT": False,
           "1811 07453": False, "": False}
    dates = {"2018-11-30": True, "2018-11-31": False, "2018-11-3": False, "30.11.2018": False, "2018-11-30T00": False}
    rows = [(i, "2018-11-30") for i in ids] + [("1811.07453", d) for d in dates]
    df = spark.createDataFrame([(i, d, "cs.LG", 1, 2) for i, d in rows],
                               "paper_id string, submitted_date string, category string, citations_12mo int, citations_24mo int")
    got = [r["violated"] == [] for r in Q.check_records(df).collect()]
    assert got == list(ids.values()) + list(dates.values())


def test_input_defaults_and_limits(spark):
    df = spark.createDataFrame([(1, "ok title", "x" * 20, None, None), (2, "no", "x" * 19, 101, "q")],
                               "seq long, title string, abstract string, authors int, category string")
    good, bad = Q.validate_inputs(df).orderBy("seq").collect()
    assert good["violated"] == [] and good["authors"] == 1 and good["category"] == "cs.LG"
    assert bad["violated"] == ["title_length", "abstract_length", "author_range"]
    assert Q.batch_size_ok(df).first()["accepted"] and not Q.batch_size_ok(df.limit(0)).first()["accepted"]


def test_audit_adds_up_and_zero_counts_stay(shelf):
    papers, citations = shelf
    joined = papers.join(citations, "paper_id")
    cutoff = dt.date(2019, 12, 31)
    audit = {r["stage"]: r["n_rows"] for r in C.filter_audit(joined, cutoff).collect()}
    assert audit == {"time_cutoff": 1, "null_citations": 0, "invalid_text": 2, "kept": 3}
    assert {r["paper_id"] for r in C.cohort(joined, cutoff).collect()} == {"p-a", "p-b", "p-e"}
    later = {r["stage"]: r["n_rows"] for r in C.filter_audit(joined, dt.date(2022, 1, 1)).collect()}
    assert later == {"time_cutoff": 0, "null_citations": 1, "invalid_text": 2, "kept": 3}
    assert C.cohort(joined, dt.date(2018, 12, 31)).count() == 2
    assert C.cohort(joined, cutoff).where("citations_24mo = 0").count() == 1


def test_bad_date_raises_or_is_null(spark):
    df = spark.createDataFrame([("2020-13-01",)], "submitted_date string")
    with pytest.raises(Exception):
        C.parse_dates(df).collect()
    assert C.parse_dates(df, lenient=True).first()["submitted"] is None


def test_report_tables(shelf):
    papers, citations = shelf
    rates = {r["column_name"]: r["null_pct"] for r in Q.null_rates(papers, citations, ["title", "abstract"], ["citations_24mo"]).collect()}
    assert rates == {"title": 0.0, "abstract": pytest.approx(100 / 6), "citations_24mo": pytest.approx(100 / 6)}
    dist = Q.citation_distribution(citations, ["citations_24mo"]).first()
    assert (dist["n"], dist["mean"], dist["median"], dist["p25"]) == (5, 12.6, 4.0, 3.0)
    orphan = citations.unionByName(citations.limit(1).withColumn("paper_id", F.lit("9999.00000")))
    found = {r["check"]: r["n_keys"] for r in Q.integrity_check(papers.unionByName(papers), orphan).collect()}
    assert found == {"repeated_paper": 6, "repeated_citation": 0, "orphan_citation": 1}


def test_upload_fills_missing_cells(spark, tmp_path):
    (tmp_path / "u.csv").write_text('title,abstract\n"A ""quoted"" one","line 1\nline 2"\n,\n')
    assert [tuple(r) for r in read_upload(spark, str(tmp_path)).collect()] == [('A "quoted" one', "line 1\nline 2"), ("", "")]
