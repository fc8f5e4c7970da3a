"""What one task holds, or whether a task does a job at all, as tables grow."""

from pyspark.sql import functions as F

import duetto.session as session
import duetto.sources.market as source
from duetto.names import DOCTOR, HOSPITAL
from duetto.operators import filters as flt
from duetto.plans import local
from duetto.plans.doctor_optimal import match_doctor_optimal
from duetto.plans.hospital_optimal import match_hospital_optimal
from duetto.sources import synth


def parts(df):
    return df.rdd.getNumPartitions()


def test_draws_of_one_small_file_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 40)
    dealt = []
    draws = synth._draws
    monkeypatch.setattr(synth, "_draws", lambda d, *a: dealt.append(parts(d)) or draws(d, *a))
    one_task = spark.range(200).select(F.col("id").alias(DOCTOR)).coalesce(1)
    for replace in (True, False):
        assert synth.generate_preferences(one_task, 20, 5, replace=replace).select(DOCTOR).distinct().count() == 200
    assert dealt == [25, 25]        # 200 lists of 5 are 1000 draws, 40 a task


def test_lines_are_dealt_out_by_their_number(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(session, "ROWS_PER_FILE", 100)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    lines = source.order_lines(spark, sf)
    assert "hashpartitioning(l_orderkey" in lines._jdf.queryExecution().toString()
    assert f", {-(-n // 100)})" in lines._jdf.queryExecution().toString()
    assert lines.count() == n


def test_a_large_layout_has_more_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.layout_partitions(spark, 1000) == cores
    assert session.layout_partitions(spark, 36_000_000) == max(cores, 36)


def test_many_edges_run_in_global_rounds(spark, monkeypatch):
    e = synth.generate_preferences(spark.range(40).select(F.col("id").alias(DOCTOR)), 6, 4, 12).cache()
    want = [sorted(m(e, 3, local=True).matching.collect()) for m in (match_doctor_optimal, match_hospital_optimal)]
    n = e.count()
    assert local.settle(e, 3, 3, DOCTOR, n) is not None
    monkeypatch.setattr(local, "SETTLE_EDGES", n - 1)
    assert local.settle(e, 3, 3, DOCTOR, n) is None
    assert local.settle(e, 3, 3, HOSPITAL, n) is None
    got = [sorted(m(e, 3, local=True).matching.collect()) for m in (match_doctor_optimal, match_hospital_optimal)]
    assert got == want


def test_one_sided_pairs_without_a_join(spark):
    schema = "doctor_id long, hospital_id long"
    d = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (3, None), (None, None)], schema)
    h = spark.createDataFrame([(2, 1), (4, 4), (4, 4), (None, 1), (None, 1), (5, None)], schema)
    got = flt.one_sided_pairs(d, h)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, [
        (1, 1, "doctor"), (None, 1, "doctor"), (3, None, "doctor"), (None, None, "doctor"),
        (4, 4, "hospital"), (None, 1, "hospital"), (5, None, "hospital")]))
    assert "Join" not in got._jdf.queryExecution().toString()
