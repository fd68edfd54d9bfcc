"""Queries for text and metadata features, TF-IDF and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.keys import hash_bucket
from scholarmill.functions.labels import decode_one_hot, pretty_feature, tagged_feature
from scholarmill.models.assemble import fit_categories
from scholarmill.operators import features as X
from scholarmill.operators import tfidf as T
from scholarmill.operators.quantiles import count_percentiles, measured_percentiles
from scholarmill.operators.split import with_split
from scholarmill.plans.registry import query
from scholarmill.plans.shape import big, r6, rounded
from scholarmill.session import write_once
from scholarmill.sources.stand_ins import DATED_SQL, TEXT_SQL, citations_text, papers_dated, papers_text

CATEGORIES = ["en", "fr", "de", "es"]
# words the given texts do hold
KEYWORDS = ["the", "und", "que", "license", "data"]
# a short list of frequent words for the oracle; any list can be passed
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "as", "by",
              "this", "are", "at", "an", "from", "or"]

WORDS_SQL = "len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> ''))"
EASE_SQL = f"""206.835 - 1.015 * {WORDS_SQL.format('abstract')}
      / greatest(1, len(regexp_extract_all(abstract, '[.!?]+')))
    - 84.6 * coalesce(list_sum(list_transform(list_filter(regexp_split_to_array(abstract, '\\s+'), lambda x: x <> ''),
        lambda w: greatest(1, len(regexp_extract_all(lower(w), '[aeiouy]+'))))) / nullif({WORDS_SQL.format('abstract')}, 0), 0)"""

FEATURES_SQL = f"""{TEXT_SQL} SELECT paper_id, {big(WORDS_SQL.format('abstract'))} AS abstract_length,
  {big(WORDS_SQL.format('title'))} AS title_length, {r6(EASE_SQL)} AS flesch_reading_ease,
  {big("len(regexp_extract_all(abstract, '[$]'))")} AS equation_count,
  {big("len(regexp_extract_all(abstract, '[[]' || '[0-9]+' || '[]]'))")} AS citation_count,
  {big("len(string_split(authors, ','))")} AS author_count, {big('month(submitted)')} AS submission_month,
  {big('year(submitted)')} AS submission_year,
  {', '.join(f"{big(f'CASE WHEN category = {c!r} THEN 1 ELSE 0 END')} AS cat_{c}" for c in sorted(CATEGORIES))},
  {', '.join(f"{big(f'''CASE WHEN contains(lower(title || ' ' || abstract), {k!r}) THEN 1 ELSE 0 END''')} AS has_{k}"
             for k in KEYWORDS)}
  FROM papers_text"""


def text_table(spark, folder) -> DataFrame:
    """Features of all papers; the categories are those that occur."""
    papers = papers_text(spark, folder)
    return X.feature_table(papers, fit_categories(papers), KEYWORDS)


def _features(columns: list[str]):
    def run(spark, folder) -> DataFrame:
        return rounded(text_table(spark, folder).select("paper_id", *columns))
    return run


def _by_prefix(*prefixes: str):
    """All columns that begin so, whichever values were fitted."""
    def run(spark, folder) -> DataFrame:
        table = text_table(spark, folder)
        return rounded(table.select("paper_id", *(F.col(f"`{c}`") for c in table.columns if c != "paper_id" and c.startswith(prefixes))))
    return run


def _features_sql(columns: list[str]) -> str:
    return f"SELECT paper_id, {', '.join(columns)} FROM ({FEATURES_SQL})"


for _name, _columns in (("word_counts", ["abstract_length", "title_length"]), ("equation_count", ["equation_count"]),
                        ("bracket_refs", ["citation_count"]), ("reading_ease", ["flesch_reading_ease"]),
                        ("keyword_flags", [f"has_{k}" for k in KEYWORDS]), ("author_count", ["author_count"])):
    query(_name, _features_sql(_columns))(_features(_columns))
# the oracles name the values that the given tables hold
query("one_hot", _features_sql([f"cat_{c}" for c in sorted(CATEGORIES)]))(_by_prefix("cat_"))
query("feature_matrix_base", _features_sql(X.feature_columns(CATEGORIES, KEYWORDS)))(_by_prefix(""))


@query("date_parts", f"""{DATED_SQL} SELECT paper_id, {big('month(submitted)')} AS submission_month,
  {big('year(submitted)')} AS submission_year FROM papers_dated""")
def date_parts(spark, folder) -> DataFrame:
    return rounded(papers_dated(spark, folder).select("paper_id", F.month("submitted").alias("submission_month"),
                                                      F.year("submitted").alias("submission_year")))


@query("decode_one_hot", f"{TEXT_SQL} SELECT paper_id, CASE WHEN category IN ('en', 'fr') THEN category END AS category FROM papers_text")
def decode(spark, folder) -> DataFrame:
    """The category read back from its flags; one that was not fitted has none."""
    flags = X.feature_table(papers_text(spark, folder), ["en", "fr"], KEYWORDS)
    return flags.select("paper_id", decode_one_hot(["en", "fr"]).alias("category"))


def feature_names(spark, folder) -> DataFrame:
    """Feature names as the data gives them: fixed ones, one per category, one per common word."""
    names = papers_text(spark, folder).select(F.concat(F.lit("cat_"), "category").alias("feature")).distinct()
    words = (papers_text(spark, folder)
             .select(F.explode(F.array_distinct(F.split(F.lower("title"), " "))).alias("w"))
             .where(F.rlike("w", F.lit("^[a-z]{4,}$"))).distinct()
             .select(F.concat(F.lit("tfidf_"), "w").alias("feature")))
    return names.unionByName(words)


NAMES_SQL = f"""{TEXT_SQL}, names AS (SELECT DISTINCT 'cat_' || category AS feature FROM papers_text
  UNION ALL SELECT DISTINCT 'tfidf_' || w FROM (SELECT unnest(string_split(lower(title), ' ')) AS w FROM papers_text)
  WHERE regexp_matches(w, '^[a-z]{{4,}}$'))"""


@query("feature_group_counts", f"""{NAMES_SQL} SELECT CASE WHEN starts_with(feature, 'tfidf_') THEN 'tfidf'
  WHEN starts_with(feature, 'cat_') THEN 'cat' WHEN starts_with(feature, 'has_') THEN 'has' ELSE 'other' END AS feature_group,
  count(*) AS n_columns FROM names GROUP BY 1""")
def feature_group_counts(spark, folder) -> DataFrame:
    return X.feature_group_counts(feature_names(spark, folder))


@query("pretty_feature_names", f"""{NAMES_SQL} SELECT feature,
  replace(replace(replace(feature, 'tfidf_', ''), 'has_', 'has:'), 'cat_', 'cat:') AS label FROM names""")
def pretty_feature_names(spark, folder) -> DataFrame:
    return feature_names(spark, folder).select("feature", pretty_feature(F.col("feature")).alias("label"))


@query("tagged_feature_names", f"""{NAMES_SQL} SELECT feature,
  replace(replace(replace(feature, 'tfidf_', ''), 'has_', '[kw] '), 'cat_', '[cat] ') AS label FROM names""")
def tagged_feature_names(spark, folder) -> DataFrame:
    return feature_names(spark, folder).select("feature", tagged_feature(F.col("feature")).alias("label"))


NUMERIC = X.feature_columns(CATEGORIES, KEYWORDS)


@query("feature_ranges", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r6(f'min({c})')} AS min_value, {r6(f'max({c})')} AS max_value FROM f" for c in NUMERIC)
    .join((f"WITH f AS ({FEATURES_SQL}) ", "")))
def feature_ranges(spark, folder) -> DataFrame:
    return rounded(X.feature_ranges(text_table(spark, folder), NUMERIC))


def _group(name: str) -> str:
    return next((g for g in ("tfidf", "cat", "has") if name.startswith(g + "_")), "other")


@query("x_stats_by_group", "\nUNION ALL\n".join(
    f"SELECT '{_group(c)}' AS feature_group, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM f" for c in NUMERIC)
    .join((f"WITH f AS ({FEATURES_SQL}), cells AS (", f""") SELECT feature_group, count(DISTINCT feature) AS n_columns,
      {r6('avg(v)')} AS mean, {r6('stddev_pop(v)')} AS std, {r6('min(v)')} AS min_value, {r6('max(v)')} AS max_value
      FROM cells GROUP BY feature_group""")))
def x_stats_by_group(spark, folder) -> DataFrame:
    return rounded(X.x_stats_by_group(X.column_moments(rounded(text_table(spark, folder)), NUMERIC)))


@query("standardize", f"WITH f AS ({FEATURES_SQL}) SELECT paper_id, " + ", ".join(
    r6(f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0)") + f" AS {c}" for c in NUMERIC)
    + " FROM f")
def standardize(spark, folder) -> DataFrame:
    return rounded(X.standardize(write_once(rounded(text_table(spark, folder)), "features"), NUMERIC))


@query("median_fill", f"""WITH f AS ({FEATURES_SQL}), m AS (SELECT quantile_cont(flesch_reading_ease, 0.5) AS ease,
    quantile_cont(abstract_length::DOUBLE, 0.5) AS words FROM f)
  SELECT paper_id, {r6('CASE WHEN paper_id % 3 = 0 THEN ease ELSE flesch_reading_ease END')} AS flesch_reading_ease,
    {r6('CASE WHEN paper_id % 5 = 0 THEN words ELSE abstract_length END')} AS abstract_length FROM f, m""")
def median_fill(spark, folder) -> DataFrame:
    """Every third readability and every fifth length is unknown and takes the median of all papers."""
    table = write_once(rounded(text_table(spark, folder).select(
        "paper_id", "flesch_reading_ease", "abstract_length")), "features")
    medians = (measured_percentiles(table, "flesch_reading_ease", [0.5])
               .select(F.col("points")[0].alias("flesch_reading_ease"))
               .withColumn("abstract_length", count_percentiles(table, "abstract_length", [0.5])
                           .select(F.col("points")[0]).scalar()))
    holes = table.withColumns({
        "flesch_reading_ease": F.when(F.col("paper_id") % 3 != 0, F.col("flesch_reading_ease")),
        "abstract_length": F.when(F.col("paper_id") % 5 != 0, F.col("abstract_length"))})
    return rounded(X.median_fill(holes, medians, ["flesch_reading_ease", "abstract_length"]))


_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
TERMS_SQL = f"""{TEXT_SQL}, words AS (SELECT paper_id, list_filter(
    regexp_extract_all(lower(abstract || ' ' || title), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda x: NOT list_contains({_STOP_SQL}, x)) AS w FROM papers_text),
  occurrences AS (SELECT paper_id, unnest(w) AS term FROM words
    UNION ALL SELECT paper_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
  per_paper AS (SELECT paper_id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
  vocabulary AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM per_paper GROUP BY term
    HAVING count(*) >= (SELECT greatest(1, least(5, greatest(1, count(*) // 10))) FROM papers_text)
    ORDER BY tf DESC, term LIMIT 500)"""


def fitted_vocabulary(spark, folder) -> T.Vocabulary:
    return T.fit_vocabulary(papers_text(spark, folder), STOP_WORDS)


@query("tfidf_vocabulary", f"{TERMS_SQL} SELECT term, tf, df FROM vocabulary")
def tfidf_vocabulary(spark, folder) -> DataFrame:
    papers = papers_text(spark, folder)
    return T.vocabulary_table(papers, fitted_vocabulary(spark, folder))


@query("tfidf_weights", f"""{TERMS_SQL}, raw AS (SELECT p.paper_id, p.term,
    p.tf * (ln((1 + (SELECT count(*) FROM papers_text)) / (1 + v.df)) + 1) AS w FROM per_paper p JOIN vocabulary v USING (term))
  SELECT paper_id, term, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY paper_id))')} AS weight FROM raw""")
def tfidf_weights(spark, folder) -> DataFrame:
    return rounded(T.tfidf_weights(papers_text(spark, folder), fitted_vocabulary(spark, folder)))


@query("tfidf_cell_stats", f"""{TERMS_SQL}, raw AS (SELECT p.paper_id, p.term,
    p.tf * (ln((1 + (SELECT count(*) FROM papers_text)) / (1 + v.df)) + 1) AS w FROM per_paper p JOIN vocabulary v USING (term)),
  weights AS (SELECT paper_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY paper_id)) AS weight FROM raw),
  cells AS (SELECT coalesce(w.weight, 0) AS x FROM papers_text CROSS JOIN vocabulary v LEFT JOIN weights w USING (paper_id, term))
  SELECT 'tfidf' AS feature_group, (SELECT count(*) FROM vocabulary) AS n_columns, {r6('avg(x)')} AS mean,
    {r6('stddev_pop(x)')} AS std, {r6('min(x)')} AS min_value, {r6('max(x)')} AS max_value FROM cells""")
def tfidf_cell_stats(spark, folder) -> DataFrame:
    """Statistics of the sparse block over all its cells, zeros included, without making them."""
    papers = papers_text(spark, folder)
    fitted = fitted_vocabulary(spark, folder)
    moments = X.sparse_moments(T.tfidf_weights(papers, fitted), T.vocabulary_table(papers, fitted),
                               papers.agg(F.count("*")).scalar())
    return rounded(X.x_stats_by_group(moments))


@query("scaled_x_stats", f"""{TERMS_SQL}, raw AS (SELECT p.paper_id, p.term,
    p.tf * (ln((1 + (SELECT count(*) FROM papers_text)) / (1 + v.df)) + 1) AS w FROM per_paper p JOIN vocabulary v USING (term)),
  weights AS (SELECT paper_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY paper_id)) AS weight FROM raw),
  f AS (SELECT * FROM ({FEATURES_SQL})),
  cols AS (SELECT 'tfidf' AS feature_group, avg(x) AS m, stddev_pop(x) AS sd, min(x) AS lo, max(x) AS hi
    FROM (SELECT term, coalesce(w.weight, 0) AS x FROM papers_text CROSS JOIN vocabulary v LEFT JOIN weights w USING (paper_id, term)) GROUP BY term
    {" ".join(f"UNION ALL SELECT '{_group(c)}', avg({c}), stddev_pop({c}), min({c}), max({c}) FROM f" for c in NUMERIC)})
  SELECT feature_group, count(*) AS n_columns, 0.0::DOUBLE AS mean, {r6('sqrt(avg(CASE WHEN sd > 0 THEN 1.0 ELSE 0.0 END))')} AS std,
    {r6('min(CASE WHEN sd > 0 THEN (lo - m) / sd ELSE 0 END)')} AS min_value, {r6('max(CASE WHEN sd > 0 THEN (hi - m) / sd ELSE 0 END)')} AS max_value
  FROM cols GROUP BY feature_group""")
def scaled_x_stats(spark, folder) -> DataFrame:
    """Statistics of the scaled matrix by feature group, TF-IDF among them, from moments of its columns."""
    papers, fitted = papers_text(spark, folder), fitted_vocabulary(spark, folder)
    sparse = X.sparse_moments(T.tfidf_weights(papers, fitted), T.vocabulary_table(papers, fitted), papers.agg(F.count("*")).scalar())
    table = rounded(text_table(spark, folder))
    base = X.column_moments(table, [c for c in table.columns if c != "paper_id"])
    return rounded(X.x_stats_by_group(X.scaled_moments(base.unionByName(sparse))))


@query("train_test_split", """SELECT doc_id AS paper_id,
  CAST(CAST(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS BIGINT) AS bucket,
  CASE WHEN CAST(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM documents""")
def train_test_split(spark, folder) -> DataFrame:
    rows = papers_text(spark, folder).select("paper_id")
    return rounded(with_split(rows.withColumn("bucket", hash_bucket(F.col("paper_id"), 5))))
