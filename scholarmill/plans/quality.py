"""Queries for selection, rules, ingest and the quality report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators import cohort as C
from scholarmill.operators import ingest as I
from scholarmill.operators import quality as Q
from scholarmill.operators.features import impute_zero
from scholarmill.operators.sketches import add_day
from scholarmill.operators.sketches import sketched_percentiles as percentiles_of_days
from scholarmill.plans.registry import query
from scholarmill.plans.shape import big, r6, rounded
from scholarmill.session import fresh_path
from scholarmill.sources.quarantine import Quarantine
from scholarmill.sources.stand_ins import (DATED_SQL, TEXT_SQL, citations_text, papers_dated,
                                           papers_text, stored_counts)
from scholarmill.sources.tables import read_table

CUTOFF = date(2021, 12, 31)
COUNTS = ("citations_12mo", "citations_24mo")
COUNTS_SQL = ", ".join(f"{big(c)} AS {c}" for c in COUNTS)


@query("filter_category_date", f"""{DATED_SQL} SELECT paper_id, category, submitted FROM papers_dated
  WHERE category IN ('PROMO', 'SMALL') AND submitted BETWEEN DATE '1995-01-15' AND DATE '1995-03-31'""")
def filter_category_date(spark, folder) -> DataFrame:
    papers = papers_dated(spark, folder).select("paper_id", "category", "submitted")
    return I.in_category_and_dates(papers, ["PROMO", "SMALL"], date(1995, 1, 15), date(1995, 3, 31))


@query("parse_dates", """SELECT o_orderkey AS paper_id, CAST(o_orderdate AS DATE) AS submitted FROM orders""")
def parse_dates(spark, folder) -> DataFrame:
    texts = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("paper_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("submitted_date"))
    return C.parse_dates(texts).drop("submitted_date")


@query("filter_valid_text", f"{TEXT_SQL} SELECT paper_id FROM papers_text WHERE length(abstract) > 10 AND length(title) > 3")
def filter_valid_text(spark, folder) -> DataFrame:
    return papers_text(spark, folder).where(C.valid_text()).select("paper_id")


def text_joined(spark, folder) -> DataFrame:
    return papers_text(spark, folder).join(citations_text(spark, folder), "paper_id", "left")


@query("filter_audit", f"""{TEXT_SQL}, staged AS (
  SELECT CASE WHEN NOT coalesce(submitted <= DATE '{CUTOFF}', false) THEN 'time_cutoff'
              WHEN citations_24mo IS NULL THEN 'null_citations'
              WHEN NOT coalesce(length(abstract) > 10 AND length(title) > 3, false) THEN 'invalid_text'
              ELSE 'kept' END AS stage FROM papers_text LEFT JOIN citations_text USING (paper_id)),
  names(stage) AS (VALUES ('time_cutoff'), ('null_citations'), ('invalid_text'), ('kept'))
  SELECT n.stage, count(s.stage) AS n_rows, (SELECT count(*) FROM staged) AS initial_rows,
         {r6('100.0 * count(s.stage) / (SELECT count(*) FROM staged)')} AS pct_of_initial
  FROM names n LEFT JOIN staged s USING (stage) GROUP BY n.stage""")
def filter_audit(spark, folder) -> DataFrame:
    return rounded(C.filter_audit(text_joined(spark, folder), CUTOFF))


@query("filter_audit_by_run", f"""{TEXT_SQL}, staged AS (
  SELECT CASE WHEN NOT coalesce(submitted <= DATE '2023-06-30' - INTERVAL 730 DAY, false) THEN 'time_cutoff'
              WHEN citations_24mo IS NULL THEN 'null_citations'
              WHEN NOT coalesce(length(abstract) > 10 AND length(title) > 3, false) THEN 'invalid_text'
              ELSE 'kept' END AS stage FROM papers_text LEFT JOIN citations_text USING (paper_id)),
  names(stage) AS (VALUES ('time_cutoff'), ('null_citations'), ('invalid_text'), ('kept'))
  SELECT n.stage, count(s.stage) AS n_rows, (SELECT count(*) FROM staged) AS initial_rows,
         {r6('100.0 * count(s.stage) / (SELECT count(*) FROM staged)')} AS pct_of_initial
  FROM names n LEFT JOIN staged s USING (stage) GROUP BY n.stage""")
def filter_audit_by_run(spark, folder) -> DataFrame:
    """The same with the cut-off that a run on a given day takes by default."""
    return rounded(C.filter_audit(text_joined(spark, folder), C.default_cutoff(date(2023, 6, 30))))


@query("impute_zero", f"""{TEXT_SQL} SELECT paper_id, coalesce(CAST(citations_12mo AS DOUBLE), 0.0) AS citations_12mo,
  coalesce(CAST(citations_24mo AS DOUBLE), 0.0) AS citations_24mo
  FROM papers_text LEFT JOIN citations_text USING (paper_id)""")
def impute(spark, folder) -> DataFrame:
    return impute_zero(text_joined(spark, folder).select("paper_id", *COUNTS), COUNTS)


@query("validate_inputs", f"""{TEXT_SQL}, asked AS (SELECT paper_id, title, abstract,
    CASE WHEN paper_id % 11 = 0 THEN NULL ELSE CAST(paper_id % 130 AS INTEGER) END AS authors FROM papers_text)
  SELECT paper_id, {big('coalesce(authors, 1)')} AS authors, 'cs.LG' AS category, array_to_string(list_filter([
    CASE WHEN NOT coalesce(length(title) BETWEEN 3 AND 500, false) THEN 'title_length' END,
    CASE WHEN NOT coalesce(length(abstract) BETWEEN 20 AND 5000, false) THEN 'abstract_length' END,
    CASE WHEN NOT coalesce(coalesce(authors, 1) BETWEEN 1 AND 100, false) THEN 'author_range' END],
    lambda x: x IS NOT NULL), ',') AS violated FROM asked""")
def validate_inputs(spark, folder) -> DataFrame:
    asked = papers_text(spark, folder).select(
        "paper_id", "title", "abstract",
        F.when(F.col("paper_id") % 11 != 0, (F.col("paper_id") % 130).cast("int")).alias("authors"),
        F.lit(None).cast("string").alias("category"))
    return rounded(Q.validate_inputs(asked).select(
        "paper_id", "authors", "category", F.array_join("violated", ",").alias("violated")))


@query("batch_size", "SELECT count(*) AS n_rows, count(*) BETWEEN 1 AND 1000 AS accepted FROM documents")
def batch_size(spark, folder) -> DataFrame:
    """Whether all documents may come as one request."""
    return Q.batch_size_ok(papers_text(spark, folder))



@query("quality_rules", f"""{TEXT_SQL}, records AS (SELECT paper_id AS seq,
    CASE WHEN paper_id % 4 = 0 THEN '2020-' ELSE '2020.' END || lpad(CAST(paper_id % 100000 AS VARCHAR), 5, '0')
      || CASE WHEN paper_id % 3 = 0 THEN 'v2' ELSE '' END AS id,
    CASE WHEN paper_id % 7 = 0 THEN '2020-02-30' WHEN paper_id % 7 = 1 THEN '2020-1-15'
         ELSE CAST(submitted AS VARCHAR) END AS day, category, citations_12mo AS c12, citations_24mo AS c24
    FROM papers_text LEFT JOIN citations_text USING (paper_id))
  SELECT seq, array_to_string(list_filter([
    CASE WHEN NOT regexp_matches(id, '^\\d{{4}}\\.\\d{{5}}(v\\d+)?$') THEN 'id_format' END,
    CASE WHEN NOT regexp_matches(day, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN 'date_format' END,
    CASE WHEN try_strptime(day, '%Y-%m-%d') IS NULL OR length(day) <> 10 THEN 'real_date' END,
    CASE WHEN category NOT IN ('en', 'fr') THEN 'category' END,
    CASE WHEN NOT coalesce(c12 >= 0 AND c12 <= c24, false) THEN 'counts' END], lambda x: x IS NOT NULL), ',') AS violated
  FROM records""")
def quality_rules(spark, folder) -> DataFrame:
    n = F.col("paper_id")
    records = text_joined(spark, folder).select(
        n.alias("seq"),
        F.concat(F.when(n % 4 == 0, "2020-").otherwise("2020."), F.lpad((n % 100000).cast("string"), 5, "0"),
                 F.when(n % 3 == 0, "v2").otherwise("")).alias("paper_id"),
        F.when(n % 7 == 0, "2020-02-30").when(n % 7 == 1, "2020-1-15")
        .otherwise(F.col("submitted").cast("string")).alias("submitted_date"), "category", *COUNTS)
    return Q.check_records(records, ["en", "fr"]).select("seq", F.array_join("violated", ",").alias("violated"))


@query("integrity_check", """SELECT 'repeated_paper' AS "check", count(*) AS n_keys FROM
    (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'repeated_citation', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'orphan_citation', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey)""")
def integrity_check(spark, folder) -> DataFrame:
    papers = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("paper_id"))
    citations = read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("paper_id"))
    return Q.integrity_check(papers, citations)


@query("join_inner", f"""{TEXT_SQL} SELECT paper_id, category, submitted, {COUNTS_SQL}
  FROM papers_text JOIN citations_text USING (paper_id)""")
def join_inner(spark, folder) -> DataFrame:
    return rounded(papers_text(spark, folder).join(citations_text(spark, folder), "paper_id")
                   .select("paper_id", "category", "submitted", *COUNTS))


@query("join_left", f"""{TEXT_SQL} SELECT paper_id, category, {COUNTS_SQL}
  FROM papers_text LEFT JOIN citations_text USING (paper_id)""")
def join_left(spark, folder) -> DataFrame:
    return rounded(text_joined(spark, folder).select("paper_id", "category", *COUNTS))


@query("anti_new_papers", f"""{TEXT_SQL} SELECT paper_id, category FROM papers_text p
  WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.item_id = p.paper_id)""")
def anti_new_papers(spark, folder) -> DataFrame:
    stored = read_table(spark, folder, "benchmark").select(F.col("item_id").alias("paper_id"))
    return I.not_stored(papers_text(spark, folder).select("paper_id", "category"), stored, "paper_id")


@query("pending_citations", f"""{TEXT_SQL} SELECT paper_id, submitted FROM papers_text
  WHERE paper_id NOT IN (SELECT paper_id FROM citations_text)""")
def pending_citations(spark, folder) -> DataFrame:
    return I.pending_citations(papers_text(spark, folder).select("paper_id", "submitted"),
                               citations_text(spark, folder))


@query("attach_12mo", f"""{TEXT_SQL} SELECT paper_id, {r6('ln(1 + quality)')} AS citations_24mo_log,
  {big('c.citations_12mo')} AS citations_12mo
  FROM (SELECT doc_id AS paper_id, quality FROM documents LEFT JOIN labels USING (doc_id)) t
  LEFT JOIN (SELECT * FROM citations_text WHERE paper_id % 3 <> 0) c USING (paper_id)""")
def attach_12mo(spark, folder) -> DataFrame:
    """The 12-month counts of two thirds of the labelled papers to the targets of all; the others have none."""
    citations = citations_text(spark, folder)
    targets = papers_text(spark, folder).select("paper_id").join(citations, "paper_id", "left").select(
        "paper_id", F.log1p("citations_24mo").alias("citations_24mo_log"))
    return rounded(targets.join(citations.where("paper_id % 3 <> 0").select("paper_id", "citations_12mo"), "paper_id", "left"))


def incoming_copies(spark, folder) -> DataFrame:
    """Texts keyed by their content, so that copies of a text are repeats of a key."""
    return papers_text(spark, folder).select(F.md5("abstract").alias("text_key"), "title", "category",
                                             F.col("paper_id").alias("seq"))


INCOMING_SQL = f"""{TEXT_SQL}, incoming AS (
  SELECT md5(abstract) AS text_key, title, category, paper_id AS seq FROM papers_text)"""
FIRST_SQL = """SELECT text_key, title, category, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY text_key ORDER BY seq) AS rn FROM {0}) WHERE rn = 1"""


@query("dedup_first", f"{INCOMING_SQL} {FIRST_SQL.format('incoming')}")
def dedup_first(spark, folder) -> DataFrame:
    return I.first_per_key(incoming_copies(spark, folder), "text_key", "seq")


@query("insert_if_absent", f"""{INCOMING_SQL}, stored AS (SELECT DISTINCT md5(text) AS text_key FROM benchmark
    UNION SELECT md5(text) FROM documents WHERE lang = 'fr'),
  fresh AS (SELECT * FROM incoming WHERE text_key NOT IN (SELECT text_key FROM stored)) {FIRST_SQL.format('fresh')}""")
def insert_if_absent(spark, folder) -> DataFrame:
    held = I.union_sources([
        read_table(spark, folder, "benchmark").select(F.md5("text").alias("text_key")),
        read_table(spark, folder, "documents").where("lang = 'fr'").select(F.md5("text").alias("text_key"))])
    return I.new_rows(incoming_copies(spark, folder), held, "text_key", "seq")


@query("union_sources", """SELECT 'documents' AS origin, md5(text) AS text_key, length(text) AS n_chars FROM documents
  UNION ALL SELECT 'conversations', md5(text), length(text) FROM conversations
  UNION ALL SELECT 'benchmark', md5(text), length(text) FROM benchmark""")
def union_sources(spark, folder) -> DataFrame:
    return I.union_sources([
        read_table(spark, folder, t).select(F.lit(t).alias("origin"), F.md5("text").alias("text_key"),
                                            F.length("text").cast("bigint").alias("n_chars"))
        for t in ("documents", "conversations", "benchmark")])


@query("capped_ingest", f"""{DATED_SQL} SELECT paper_id, category, submitted,
    CASE category WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 2 ELSE 3 END::BIGINT AS priority
  FROM papers_dated WHERE category IN ('SMALL', 'LARGE', 'PROMO')
    AND paper_id NOT IN (SELECT item_id FROM benchmark)
  ORDER BY priority, submitted, paper_id LIMIT 500""")
def capped_ingest(spark, folder) -> DataFrame:
    stored = read_table(spark, folder, "benchmark").select(F.col("item_id").alias("paper_id"))
    papers = papers_dated(spark, folder).select("paper_id", "category", "submitted")
    return rounded(I.capped_ingest(papers, stored, ["SMALL", "LARGE", "PROMO"], 500))


@query("coverage", f"""{TEXT_SQL} SELECT (SELECT count(*) FROM papers_text) AS total_papers,
  (SELECT count(*) FROM citations_text) AS with_citations,
  {r6('100.0 * (SELECT count(*) FROM citations_text) / (SELECT count(*) FROM papers_text)')} AS coverage_pct""")
def coverage(spark, folder) -> DataFrame:
    return rounded(Q.coverage(papers_text(spark, folder), citations_text(spark, folder)))


@query("null_rates", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {r6(f'100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS null_pct FROM j"
    for c in ("title", "abstract", "authors", *COUNTS)).join(
        (f"{TEXT_SQL}, j AS (SELECT * FROM papers_text LEFT JOIN citations_text USING (paper_id)) ", "")))
def null_rates(spark, folder) -> DataFrame:
    return rounded(Q.null_rates(papers_text(spark, folder), citations_text(spark, folder),
                                ["title", "abstract", "authors"], COUNTS))


def _distribution_sql(c: str) -> str:
    points = ", ".join(f"{r6(f'quantile_cont({c}::DOUBLE, {p})')} AS {n}" for n, p in
                       (("median", 0.5), ("p25", 0.25), ("p75", 0.75), ("p90", 0.9), ("p99", 0.99)))
    return f"""SELECT '{c}' AS horizon, count({c}) AS n, {r6(f'avg({c})')} AS mean,
      {r6(f'stddev_samp({c})')} AS std, {points} FROM horizon"""


@query("citation_distribution", f"{DATED_SQL} {' UNION ALL '.join(_distribution_sql(c) for c in COUNTS)}")
def citation_distribution(spark, folder) -> DataFrame:
    return rounded(Q.citation_distribution(stored_counts(spark, folder), COUNTS))


@query("papers_per_category", f"{TEXT_SQL} SELECT category, count(*) AS n_papers FROM papers_text GROUP BY category ORDER BY category")
def papers_per_category(spark, folder) -> DataFrame:
    return Q.papers_per_category(papers_text(spark, folder))


@query("ingest_report", f"""{TEXT_SQL}, j AS (SELECT p.*, c.citations_12mo, c.citations_24mo, c.paper_id AS held
    FROM papers_text p LEFT JOIN citations_text c USING (paper_id))
  SELECT 'total_papers' AS figure, {r6('count(*)')} AS value FROM j UNION ALL SELECT 'with_citations', {r6('count(held)')} FROM j
  UNION ALL SELECT 'coverage_pct', {r6('100.0 * count(held) / count(*)')} FROM j
  {" ".join(f"UNION ALL SELECT 'null_pct.{c}', {r6(f'100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*)')} FROM j"
            for c in ("title", "abstract", "authors", *COUNTS))}""")
def ingest_report(spark, folder) -> DataFrame:
    """Coverage and null shares, observed while the joined rows are written."""
    papers = papers_text(spark, folder).select("paper_id", "title", "abstract", "authors")
    return rounded(Q.write_with_report(papers, citations_text(spark, folder), ["title", "abstract", "authors"], COUNTS,
                                       fresh_path(spark, "ingested")))


QUARANTINE_SQL = """SELECT paper_id, array_to_string(list_filter([
    CASE WHEN NOT coalesce(length(title) BETWEEN 3 AND 500, false) THEN 'title_length' END,
    CASE WHEN NOT coalesce(length(abstract) BETWEEN 20 AND 5000, false) THEN 'abstract_length' END,
    CASE WHEN NOT coalesce(authors BETWEEN 1 AND 100, false) THEN 'author_range' END], lambda x: x IS NOT NULL), ',') AS violated"""


@query("quarantine_replay", f"""{TEXT_SQL}, asked AS (SELECT paper_id, title, abstract, paper_id % 130 AS authors FROM papers_text),
  first AS ({QUARANTINE_SQL} FROM asked),
  mended AS (SELECT paper_id, title, left(abstract, 5000) AS abstract, greatest(1, least(100, authors)) AS authors
    FROM asked JOIN first USING (paper_id) WHERE violated <> ''),
  again AS ({QUARANTINE_SQL} FROM mended)
  SELECT paper_id, CAST(0 AS BIGINT) AS round, true AS accepted, violated FROM first WHERE violated = ''
  UNION ALL SELECT paper_id, 1, violated = '', violated FROM again""")
def quarantine_replay(spark, folder) -> DataFrame:
    """Requests are checked, and those that were rejected once more with long abstracts cut and author numbers bounded."""
    asked = papers_text(spark, folder).select("paper_id", "title", "abstract", (F.col("paper_id") % 130).cast("int").alias("authors"),
                                              F.lit("cs.LG").alias("category"))
    kept = Quarantine(spark, fresh_path(spark, "requests"), asked.schema, Q.validate_inputs)
    kept.admit(asked, 0)
    kept.replay(lambda rows: rows.withColumns({"abstract": F.left("abstract", F.lit(5000)),
                                               "authors": F.greatest(F.lit(1), F.least(F.lit(100), "authors"))}))
    valid = kept.valid().select("paper_id", "round", F.lit(True).alias("accepted"), F.lit("").alias("violated"))
    waiting = kept.rejected().select("paper_id", "round", F.lit(False).alias("accepted"), F.array_join("violated", ",").alias("violated"))
    return rounded(valid.unionByName(waiting))


@query("sketched_percentiles", f"""{DATED_SQL} SELECT category, count(*) AS n,
  {", ".join(f"{r6(f'quantile_disc(citations_24mo::DOUBLE, {p})')} AS p{round(100 * p)}" for p in Q.REPORT_POINTS)} FROM horizon GROUP BY category""")
def sketched_percentiles(spark, folder) -> DataFrame:
    """From sketches per category and day that were stored one day after the other; up to their size they are exact."""
    counted, path = stored_counts(spark, folder), fresh_path(spark, "sketches")
    for number in range(3):
        add_day(counted.where(F.col("paper_id") % 3 == number), f"2020-01-0{number + 1}", "citations_24mo", "category", path)
    found = percentiles_of_days(spark, path, Q.REPORT_POINTS)
    return rounded(found.select(F.col("group").alias("category"), "n", *(F.col("points")[i].alias(f"p{round(100 * p)}")
                                                                         for i, p in enumerate(Q.REPORT_POINTS))))


@query("date_coverage", f"{DATED_SQL} SELECT min(submitted) AS earliest, max(submitted) AS latest FROM papers_dated")
def date_coverage(spark, folder) -> DataFrame:
    return Q.date_coverage(papers_dated(spark, folder))


@query("distinct_categories", f"{TEXT_SQL} SELECT DISTINCT category FROM papers_text")
def distinct_categories(spark, folder) -> DataFrame:
    return Q.distinct_values(papers_text(spark, folder), "category")
