"""The pipeline's stages and its run against what the operators say of each document."""

import collections

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from carelake.llm import bpe, decontamination, jaccard_join, queries, secrets
from test_operators import ODD, brute_components, brute_spans, put

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs, (docs := spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_in_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "benchmark", "secrets", "token_ids"]
    for name in list(steps)[:-1]:
        assert steps[name][1].columns == corpus_pipeline.COLUMNS


def test_stages_bound_the_bytes_of_arrow_batches(spark, tmp_dir):
    """Long rows reach a Python worker some at a time, whatever their number."""
    docs = spark.range(40).selectExpr("id doc_id", "repeat('word ', 200000) text", "'en' lang", "'s' source", "1000000L n_chars")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    for name, stage in corpus_pipeline.STAGES:
        if name != "secrets":
            spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
            stage(spark, docs.limit(1), SF)
            most = docs.coalesce(1).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
            assert most <= 2 * corpus_pipeline.BATCH_BYTES, name


def test_near_duplicates_keep_one_of_each_group(steps):
    before, after = steps["near_duplicates"]
    assert ids(after) == sorted({c for _, _, c in brute_components(rows(before))})


def test_near_duplicates_tell_rows_apart_that_share_an_id(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    near = a.replace("twelve", "twelve thirteen")
    b = "a text of its own that has nothing in common with the other one at all"
    rows = [(1, a), (5, a), (5, b), (7, a), (7, near), (8, near), (2, b + " x"), (9, ""), (9, ""), (None, a), (3, "lone words here"),
            (3, "lone words here"), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    want = [(1, a), (2, b + " x"), (3, "lone words here"), (4, None), (9, ""), (9, ""), (None, a)]
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(want, key=str)
    alone = spark.createDataFrame([(1, a, "", "", 1), (5, a, "", "", 1), (5, b, "", "", 1), (6, a, "", "", 1), (6, near, "", "", 1)], SCHEMA)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, alone, SF).collect()]
    assert sorted(kept) == [(1, a), (5, b)]


def test_benchmark_passages_go(steps, spark):
    before, after = steps["benchmark"]
    items = [decontamination.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, t in rows(before) if any(x in decontamination.normalise(t) for x in items)}
    assert bad and set(ids(before)) - set(ids(after)) == bad


def test_secrets_are_replaced(steps):
    before, after = steps["secrets"]
    old, new = dict(rows(before)), dict(rows(after))
    assert set(old) == set(new)
    for i, text in old.items():
        if brute_spans(text):
            assert "[SECRET]" in new[i] and not brute_spans(new[i])
        else:
            assert new[i] == text
    assert after.where("n_chars <> length(text)").count() == before.where("n_chars <> length(text)").count()


def test_run_equals_the_stages(steps, spark):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    got = entry.queries()["pipeline"](spark, SF)
    assert key(got) == key(steps["token_ids"][1])
    want = bpe.encoded_digests(steps["token_ids"][0], public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert key(got) == key(want)


def test_odd_rows_pass_every_stage(spark, tmp_dir):
    lines = [(i, t, None, None, None) for i, t in ODD] + [(8, "other text of the same id", "en", "s", 25)]
    docs = spark.createDataFrame(lines, SCHEMA).withColumn("spans", F.lit("x")).withColumn("score", F.lit(1))
    sf = put(spark, tmp_dir, documents=docs, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
             benchmark=spark.createDataFrame([(1, None)], "item_id long, text string"))
    got = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 1, 7: 1, 8: 2, 9: 1}
    none = put(spark, f"{tmp_dir}/none", documents=docs.limit(0), labels=spark.read.parquet(f"{sf}/labels.parquet"),
               benchmark=spark.read.parquet(f"{sf}/benchmark.parquet").limit(0))
    assert corpus_pipeline.run(spark, none).count() == 0


def test_every_operator_has_a_query():
    names = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert names == list(range(1, 14)) and set(queries.QUERIES) <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())
