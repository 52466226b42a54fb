import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import decontamination
from test_line_dedup import plain_chunks, plain_passages, without
from test_simhash import plain_stay

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after each stage, stored as the stages store them."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = docs.collect(), spark.read.parquet(path)
        docs = out[name][1]
    return out


def test_columns(steps):
    for name, (_, after) in steps.items():
        assert after.columns == (list(pipeline.COLUMNS) if name != "tokens" else ["doc_id", "n_tokens", "ids", "decoded"])
        assert after.count() > 0


def test_quality_keeps_documents_unchanged(steps):
    before, after = steps["quality"]
    assert set(map(tuple, after.collect())) < {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in before}


def test_lines(steps):
    before, after = steps["lines"]
    rows = [(r.doc_id, r.text) for r in before]
    chunks, passages = plain_chunks(rows), plain_passages(rows)
    want = without(rows, {k: chunks[k] | set(passages.get(k, ())) for k, _ in rows})
    assert {r.doc_id: r.text for r in after.collect()} == {k: text for k, _, _, text in want}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    assert {r.doc_id for r in after.collect()} == plain_stay([(r.doc_id, r.text) for r in before])


def test_benchmark(steps, spark):
    before, after = steps["benchmark"]
    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after.collect()}
    assert {r.doc_id for r in before if not any(i in decontamination.normal(r.text) for i in items)} == kept


def test_tokens(steps):
    before, after = steps["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r.doc_id: r.ids for r in after.collect()}
    assert found == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in before}


def test_run_is_the_stages_in_turn(spark, steps):
    assert sorted(map(str, pipeline.run(spark, SMALL).collect())) == sorted(map(str, steps["tokens"][1].collect()))


def test_awkward_documents(spark, awkward):
    docs = awkward.selectExpr("doc_id", "text", "'en' AS lang", "CAST(NULL AS string) AS source", "CAST(length(text) AS long) AS n_chars", "key", "fp")
    for docs, (_, stage) in zip([docs, docs, docs, docs, docs], pipeline.STAGES):
        stage(spark, docs, SMALL).count()
        assert stage(spark, docs.limit(0), SMALL).count() == 0
