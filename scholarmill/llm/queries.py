"""The named queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scholarmill.llm import (bpe, collocations, counts, egojoin, exactdup, lang, leaks, licences, repeats, secrets,
                              simhash, tokenfiles, whitening)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def named(name: str, oracle: str | None = None):
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@named("op1_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary_path("byte_bpe_50k.tiktoken"), pattern()
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), *ranks))


@named("op2_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=1)
    return tokenfiles.digests(tokenfiles.read(manifest))


@named("op3_vector_join", """
WITH RECURSIVE vectors AS (
    SELECT DISTINCT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
usable AS (
    SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
      AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       coalesce(vec_id = least(vec_id, coalesce(m, vec_id)), false) AS kept
FROM vectors
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY a) USING (vec_id)
""")
def vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_copies(table(spark, sf_dir, "embeddings"))


@named("op4_repeated_strings")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.remove(table(spark, sf_dir, "documents")))


@named("op5_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"), pattern()))


@named("op6_licence_scan")
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digests(licences.scan(table(spark, sf_dir, "documents")))


@named("op7_decontamination", """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM benchmark WHERE item_id IS NOT NULL),
cut AS (
    SELECT DISTINCT item, least(len(words), 10) AS k, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS gram
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
places AS (
    SELECT d.doc_id, d.i, cut.k, cut.item
    FROM (SELECT DISTINCT k FROM cut) ks
    CROSS JOIN LATERAL (SELECT doc_id, i, array_to_string(words[i:i + ks.k - 1], ' ') AS gram
                        FROM (SELECT doc_id, words, unnest(range(1, len(words) - ks.k + 2)) AS i FROM docs
                              WHERE len(words) >= ks.k)) d
    JOIN cut ON cut.k = ks.k AND cut.gram = d.gram),
hit AS (SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS w FROM places) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, item FROM places) GROUP BY doc_id)
SELECT docs.doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(found.items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.digests(leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@named("op8_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


@named("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lang.predict(docs, lang.fit(docs.filter(~lang.held_out())))
    return found.select("doc_id", lang.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@named("op10_simhash_golay")
def simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.classes(table(spark, sf_dir, "documents")))


@named("op11_exact_dedup", """
WITH docs AS (
    SELECT doc_id, coalesce(length(text), 0) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
ranked AS (
    SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS n,
           row_number() OVER own AS place, first_value(doc_id) OVER own AS keep_id
    FROM docs WINDOW own AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM ranked
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.digests(exactdup.decide(exactdup.intake(spark, f"{sf_dir}/documents.parquet").read_on()))


@named("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digests(whitening.whiten(table(spark, sf_dir, "embeddings")))


@named("op13_phrase_mining", """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM cut, (VALUES (1), (2), (3)) ks(k) WHERE len(words) >= k)
    GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
sides AS (
    SELECT lang, phrase, a, c, array_to_string(w[:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
    FROM (SELECT lang, phrase, a, w, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
    SELECT s.lang, s.phrase, s.a, l.f AS l, r.f AS r, 1000000::HUGEINT * s.a * s.a // (l.f::HUGEINT * r.f) AS score,
           row_number() OVER (PARTITION BY s.lang, s.phrase ORDER BY 1000000::HUGEINT * s.a * s.a // (l.f::HUGEINT * r.f), c) AS place
    FROM sides s JOIN grams l ON l.lang = s.lang AND l.phrase = s.lp JOIN grams r ON r.lang = s.lang AND r.phrase = s.rp),
around AS (
    SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3)
    GROUP BY lang, phrase),
held AS (
    SELECT s.* FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE place = 1 AND (o.a IS NULL OR len(string_split(s.phrase, ' ')) = 3 OR 100 * o.a < 50 * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM held)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))
