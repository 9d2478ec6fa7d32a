"""Registered queries against their SQL, and the pipeline against its parts, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveyloom.llm import queries, repeats, secret_scan, simhash
from tests.conftest import plan

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(want.columns).collect())) == Counter(want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_sharding_is_native(spark):
    assert "Python" not in plan(queries.QUERIES["op4_sharding"](spark, SF))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, seen = docs, {}
    for name, work in corpus_pipeline.STAGES:
        work(spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == docs.columns
        seen[name] = before, after
        before = after
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0")
    was, kept = seen["toxicity"]
    clean = was.join(toxic, "doc_id", "left_semi")
    assert clean.join(kept, "doc_id", "left_semi").count() >= 0.95 * clean.count()
    was, kept = seen["simhash"]
    groups = simhash.near_duplicates(was).select("component_id").distinct()
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter(r[0] for r in groups.collect())
    was, kept = seen["substrings"]
    assert was.count() == kept.count()
    assert repeats.remove_repeats(kept).agg(F.sum("n_removed")).first()[0] <= repeats.remove_repeats(was).agg(F.sum("n_removed")).first()[0]
    was, kept = seen["secrets"]
    assert was.count() == kept.count()
    assert not any(secret_scan.base_spans(r["text"] or "") for r in kept.select("text").collect())
    was, packed = seen["packing"]
    assert packed.select("doc_id").distinct().count() == was.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, work in corpus_pipeline.STAGES[:-1]:
        assert work(spark, docs, SF).count() == 0
