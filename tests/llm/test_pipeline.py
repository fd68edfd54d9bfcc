"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import hashlib

import duckdb
import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from test_copies import brute_classes  # noqa: E402
from test_text_ops import brute_leaks  # noqa: E402

from scholarmill.llm import bpe, lang, secrets  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """The smallest tables with rows added that every stage has to deal with."""
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet' WHERE text IS NOT NULL ORDER BY item_id LIMIT 1").fetchall()[0][0]
    some = docs.orderBy("doc_id").limit(2).collect()
    added = [(9001, None, "en"), (9002, "", None), (9003, "12 34 !", "en"), (9004, some[0].text, "en"), (9005, some[0].text + " x", None),
             (9006, f"{some[1].text}\n{item}", "en"), (9007, " ".join(some[1].text.split()[::-1]) + " password=abcdef123", "de")]
    extra = spark.createDataFrame([(k, t, lg, "added", None) for k, t, lg in added], docs.schema)
    docs.union(extra).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, folder):
    import tiktoken

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    model = lang.fit(docs.filter(~lang.held_out()))
    held = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    def stage(number, rows):
        out = corpus_pipeline.STAGES[number][1](spark, rows, folder)
        if number < 4:
            assert out.columns == columns
        return out

    docs = stage(0, docs)
    held = {k: t for k, t in held.items() if t is not None and not model.predict(t)[2]}
    assert {r.doc_id: r.text for r in docs.collect()} == held and not {9001, 9002, 9003} & set(held)

    docs = stage(1, docs)
    classes = brute_classes(list(held), list(held.values()))
    held = {k: t for k, t in held.items() if classes[k][1] == k}
    assert {r.doc_id: r.text for r in docs.collect()} == held and 9004 not in held

    docs = stage(2, docs)
    held = {k: t for k, t in held.items() if not brute_leaks(t, items)[1]}
    assert {r.doc_id: r.text for r in docs.collect()} == held and 9006 not in held

    docs = stage(3, docs)
    encoding = secrets.tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    held = {k: secrets.cut(t, secrets.spans(t, encoding), "[secret]") for k, t in held.items()}
    assert {r.doc_id: r.text for r in docs.collect()} == held
    assert "password" not in held[9007] and held[9007].endswith(" [secret]")

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks)
    expected = {}
    for k, t in held.items():
        ids = library.encode_ordinary(t)
        expected[k] = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
    assert {r.doc_id: tuple(r)[1:] for r in stage(4, docs).collect()} == expected
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, folder).collect()} == expected


def test_no_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
