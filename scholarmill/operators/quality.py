"""Data-quality rules and the quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scholarmill.operators.quantiles import count_percentiles

# Limits of a scoring request.
TITLE_LENGTH = (3, 500)
ABSTRACT_LENGTH = (20, 5000)
AUTHOR_RANGE = (1, 100)
BATCH_ROWS = (1, 1000)
DEFAULT_AUTHORS = 1
DEFAULT_CATEGORY = "cs.LG"

# Formats of stored records.
ID_FORMAT = r"^\d{4}\.\d{5}(v\d+)?$"
DATE_FORMAT = r"^\d{4}-\d{2}-\d{2}$"
CATEGORIES = ("cs.LG", "cs.AI", "econ.GN", "stat.ML")

# Percentiles of the citation distribution in the report.
REPORT_POINTS = (0.25, 0.5, 0.75, 0.9, 0.99)


def violations(rules: dict[str, Column]) -> Column:
    """Names of the violated rules, in the order given; a rule that is null counts as violated."""
    named = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()))
    return F.filter(named, lambda n: n.isNotNull())


def input_rules() -> dict[str, Column]:
    title, abstract = F.length("title"), F.length("abstract")
    return {"title_length": title.between(*TITLE_LENGTH),
            "abstract_length": abstract.between(*ABSTRACT_LENGTH),
            "author_range": F.col("authors").between(*AUTHOR_RANGE)}


def validate_inputs(requests: DataFrame) -> DataFrame:
    """Applies the defaults and adds ``violated``; split on its emptiness to quarantine rows."""
    filled = requests.fillna({"authors": DEFAULT_AUTHORS, "category": DEFAULT_CATEGORY})
    return filled.withColumn("violated", violations(input_rules()))


def batch_size_ok(requests: DataFrame) -> DataFrame:
    return requests.agg(F.count("*").alias("n_rows")).withColumn(
        "accepted", F.col("n_rows").between(*BATCH_ROWS))


def record_rules(categories: Sequence[str] = CATEGORIES) -> dict[str, Column]:
    day = F.col("submitted_date")
    return {"id_format": F.rlike("paper_id", F.lit(ID_FORMAT)),
            "date_format": F.rlike(day, F.lit(DATE_FORMAT)),
            "real_date": F.try_to_date(day, "yyyy-MM-dd").isNotNull(),
            "category": F.col("category").isin(list(categories)),
            "counts": ((F.col("citations_12mo") >= 0)
                       & (F.col("citations_12mo") <= F.col("citations_24mo")))}


def check_records(records: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    return records.withColumn("violated", violations(record_rules(categories)))


def integrity_check(papers: DataFrame, citations: DataFrame, key: str = "paper_id") -> DataFrame:
    """Repeated paper ids, repeated citation ids and citations without a paper, as counts.

    The orphan check compares distinct keys, so a repeated id costs its copies only once.
    """
    def repeated(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(key).count().where("count > 1")
                .agg(F.count("*").alias("n_keys")).select(F.lit(name).alias("check"), "n_keys"))

    orphans = (citations.select(key).distinct().join(papers.select(key), key, "left_anti")
               .agg(F.count("*").alias("n_keys"))
               .select(F.lit("orphan_citation").alias("check"), "n_keys"))
    return (repeated(papers, "repeated_paper").unionByName(repeated(citations, "repeated_citation"))
            .unionByName(orphans))


def coverage(papers: DataFrame, citations: DataFrame) -> DataFrame:
    """Papers, citation rows and their ratio in percent."""
    held = citations.agg(F.count("*").alias("n")).scalar()
    return (papers.agg(F.count("*").alias("total_papers"))
            .withColumn("with_citations", held)
            .withColumn("coverage_pct",
                        F.try_divide(F.col("with_citations") * 100.0, F.col("total_papers"))))


def null_rates(papers: DataFrame, citations: DataFrame, paper_columns: Sequence[str],
               citation_columns: Sequence[str], key: str = "paper_id") -> DataFrame:
    """Null share per column in percent: citation columns count papers without a citation row."""
    joined = papers.select(key, *paper_columns).join(citations.select(key, *citation_columns), key, "left")
    columns = [*paper_columns, *citation_columns]
    rates = joined.agg(*(F.avg(F.col(c).isNull().cast("int") * 100.0).alias(c) for c in columns))
    return rates.unpivot([], columns, "column_name", "null_pct")


def write_with_report(papers: DataFrame, citations: DataFrame, paper_columns: Sequence[str], citation_columns: Sequence[str],
                      path: str, key: str = "paper_id") -> DataFrame:
    """Writes papers with their citations, and returns coverage and null shares, observed while the rows were written.

    ``(figure, value)``: ``total_papers``, ``with_citations``, ``coverage_pct``, and ``null_pct.<column>``.  No row is read
    for them again.  A paper with several citation rows counts once for each.
    """
    held = citations.select(key, *citation_columns).withColumn("_held", F.lit(True))
    joined = papers.join(held, key, "left")
    columns = [*paper_columns, *citation_columns]
    seen = Observation("ingest")
    observed = joined.observe(seen, F.count("*").alias("total_papers"), F.count("_held").alias("with_citations"),
                              *(F.count_if(F.col(c).isNull()).alias(f"null.{c}") for c in columns))
    observed.drop("_held").write.mode("overwrite").parquet(path)
    found = seen.get
    n = found["total_papers"]

    def share(part: int) -> float | None:
        return 100.0 * part / n if n else None

    rows = [("total_papers", float(n)), ("with_citations", float(found["with_citations"])), ("coverage_pct", share(found["with_citations"])),
            *((f"null_pct.{c}", share(found[f"null.{c}"])) for c in columns)]
    return papers.sparkSession.createDataFrame(rows, "figure string, value double")


def citation_distribution(citations: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation and percentiles per horizon, nulls left out."""
    out = None
    for c in columns:
        row = (count_percentiles(citations, c, REPORT_POINTS)
               .withColumn("std", citations.agg(F.stddev_samp(c)).scalar())
               .select(F.lit(c).alias("horizon"), "n", "mean", F.col("points")[1].alias("median"), "std",
                       F.col("points")[0].alias("p25"), F.col("points")[2].alias("p75"),
                       F.col("points")[3].alias("p90"), F.col("points")[4].alias("p99")))
        out = row if out is None else out.unionByName(row)
    return out


def papers_per_category(papers: DataFrame) -> DataFrame:
    return papers.groupBy("category").agg(F.count("*").alias("n_papers")).orderBy("category")


def date_coverage(papers: DataFrame) -> DataFrame:
    return papers.agg(F.min("submitted").alias("earliest"), F.max("submitted").alias("latest"))


def distinct_values(papers: DataFrame, column: str) -> DataFrame:
    return papers.select(column).distinct()
