from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from keyweave.llm.common import (
    ARROW_BYTES,
    BATCH_BYTES,
    CLEAN_SHUFFLES,
    materialise,
    table,
    worker_free,
    worker_object,
)
from tests.llm.conftest import prose
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def names():
    return sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline")


def test_all_operators_are_registered():
    assert [n for n in (f"op{i}_" for i in range(1, 14))
            if sum(x.startswith(n) for x in names()) != 1] == []
    assert "pipeline" in names()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", [n for n in names() if n in entry.oracle_sql()])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert digest(df.columns, rows) == digest(cols, res.fetchall())


def test_stages_take_effect(spark, documents):
    import corpus_pipeline

    passage, bench = prose(70, 60), prose(71, 30)
    clean = [(i, prose(300 + i, 120), "en") for i in range(20)]
    rows = [*clean, (30, None, "en"), (31, "123 !!", "en"),  # no language
            (40, clean[0][1], "en"), (41, clean[1][1] + " end", "en"),  # copies
            (50, prose(80, 60) + " " + passage, "en"), (51, passage + " " + prose(81, 60), "en"),
            (60, bench + " " + prose(82, 40), "en"), (61, prose(83, 900) + " " + bench, "en")]
    docs = documents(rows)
    benchmark = spark.createDataFrame([(1, bench)], "item_id long, text string")
    left = {}
    from keyweave.session import ensure_checkpoint_dir

    sf_dir = f"{ensure_checkpoint_dir(spark)}/pipeline-test"
    benchmark.write.mode("overwrite").parquet(f"{sf_dir}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.schema == docs.schema
        out.write.mode("overwrite").parquet(f"{sf_dir}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{sf_dir}/{name}")
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    everything = {r[0] for r in rows}
    assert everything - left["language_id"] == {30, 31}
    assert left["language_id"] - left["near_dedup"] == {40, 41}
    assert left["near_dedup"] == left["substring_dedup"]
    assert left["substring_dedup"] - left["benchmark_decontamination"] == {60}
    assert left["packing"] == left["benchmark_decontamination"]
    text = {r.doc_id: r.text for r in table(spark, sf_dir, "benchmark").sparkSession.read.parquet(
        f"{sf_dir}/substring_dedup").collect()}
    assert passage in text[50] and passage not in text[51]


def test_run_on_an_empty_table(spark, documents):
    import corpus_pipeline
    from keyweave.session import ensure_checkpoint_dir

    sf_dir = f"{ensure_checkpoint_dir(spark)}/pipeline-empty"
    documents([]).write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(
        f"{sf_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_no_shuffle_files_are_left_of_a_written_step(spark):
    def shuffles():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles().toList()
        return {n for i in range(files.size())
                if (n := files.apply(i).getName()).startswith("shuffle_")}

    before, was = shuffles(), spark.conf.get(CLEAN_SHUFFLES, None)
    out = materialise(spark.range(1001).selectExpr("id % 7 AS k").groupBy("k").count(), "few")
    assert {tuple(r) for r in out.collect()} == {(k, 143) for k in range(7)}
    assert shuffles() <= before and spark.conf.get(CLEAN_SHUFFLES, None) == was


def test_stages_bound_their_batches(spark, documents):
    import pyarrow as pa
    from pyspark.sql import functions as F

    import corpus_pipeline

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    was = spark.conf.get(ARROW_BYTES)
    try:
        spark.conf.unset(ARROW_BYTES)
        corpus_pipeline.STAGES[0][1](spark, documents([(1, prose(1, 9), "en")]), "")
        long = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
        n = [r.n for r in long.mapInArrow(sizes, "n long").collect()]
        assert sum(n) >= 30_000_000 and max(n) < 1.1 * BATCH_BYTES
        spark.conf.set(ARROW_BYTES, "1000000")  # a lower bound stays
        corpus_pipeline.STAGES[0][1](spark, documents([(1, prose(1, 9), "en")]), "")
        assert spark.conf.get(ARROW_BYTES).rstrip("b") == "1000000"
    finally:
        spark.conf.set(ARROW_BYTES, was)


def test_worker_gives_back_what_it_kept():
    worker_object(("test-kept", 1), list).append(1)
    worker_object(("test-other",), list).append(2)
    worker_free("test-kept")
    assert worker_object(("test-kept", 1), list) == []
    assert worker_object(("test-other",), list) == [2]
    worker_free("test-none")
