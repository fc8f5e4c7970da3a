"""The loops lay out the heads of the proposers' lists, and one task solves many small knapsacks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import duetto.plans.doctor_optimal as do
import duetto.plans.hospital_optimal as ho
from duetto.names import DOCTOR, HOSPITAL
from duetto.operators import knapsack
from duetto.plans import common
from duetto.sources.synth import generate_preferences


def _edges(spark, doctors=60, hospitals=9, choices=7):
    ids = spark.range(doctors).select(F.col("id").alias(DOCTOR))
    return generate_preferences(ids, hospitals, choices, 3, replace=False).checkpoint()


def _outcome(r):
    return sorted((x[DOCTOR], x[HOSPITAL]) for x in r.matching.collect()), r.rounds, r.changes


@pytest.mark.parametrize("match", [ho.match_hospital_optimal, do.match_doctor_optimal])
@pytest.mark.parametrize("quota", [1, 3, 12])
def test_heads_give_the_rounds_of_whole_lists(spark, monkeypatch, match, quota):
    e = _edges(spark)
    monkeypatch.setattr(common, "HEAD_RANKS", 1 << 20)
    whole = [_outcome(match(e, quota, trace=t)) for t in (True, False)]
    monkeypatch.setattr(common, "HEAD_RANKS", 1)
    assert [_outcome(match(e, quota, trace=t)) for t in (True, False)] == whole


def test_heads_with_quotas_and_ranks_with_gaps(spark, monkeypatch):
    e = _edges(spark).withColumn("hospital_rank", F.col("hospital_rank") * 37 - 50).withColumn(
        "doctor_rank", F.col("doctor_rank") * 1000).checkpoint()
    quota = spark.range(9).select(F.col("id").alias(HOSPITAL), (F.col("id") % 4).cast("int").alias("quota"))
    for match in (ho.match_hospital_optimal, do.match_doctor_optimal):
        monkeypatch.setattr(common, "HEAD_RANKS", 1 << 20)
        whole = _outcome(match(e, quota, trace=True))
        monkeypatch.setattr(common, "HEAD_RANKS", 1)
        assert _outcome(match(e, quota, trace=True)) == whole


@pytest.mark.parametrize("module, name, match", [(ho, "layout", ho.match_hospital_optimal),
                                                 (do, "_layout", do.match_doctor_optimal)])
def test_rounds_lay_out_the_edges_they_may_need(spark, monkeypatch, module, name, match):
    """Everybody's first choice has a place, so the first cell is enough."""
    n = 40
    e = spark.range(n).crossJoin(spark.range(n).select(F.col("id").alias("h"))).select(
        F.col("id").alias(DOCTOR), F.col("h").alias(HOSPITAL),
        ((F.col("h") - F.col("id") + n) % n + 1).cast("int").alias("doctor_rank"),
        ((F.col("id") - F.col("h") + n) % n + 1).cast("int").alias("hospital_rank")).checkpoint()
    laid, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda df, *a, **k: laid.append(df.count()) or real(df, *a, **k))
    r = match(e, 1, trace=True)
    assert sorted((x[DOCTOR], x[HOSPITAL]) for x in r.matching.collect()) == [(i, i) for i in range(n)]
    assert laid == [n * common.HEAD_RANKS]       # of n * n


def test_hospitals_of_a_task_are_solved_from_batches_of_any_size():
    r = np.random.default_rng(5)
    rows = pd.DataFrame({HOSPITAL: np.sort(r.integers(0, 12, 300)), DOCTOR: np.arange(300), "utility": r.integers(1, 6, 300),
                         "price": r.integers(1, 40, 300)}).assign(budget=lambda x: 50 + x[HOSPITAL] * 9)
    want = pd.concat([knapsack.solve_knapsack(x) for _, x in rows.groupby(HOSPITAL)], ignore_index=True)
    for size in (1, 7, 25, 300):
        parts = [rows.iloc[a:a + size] for a in range(0, 300, size)]
        got = pd.concat(knapsack.solve_sorted(iter([rows.iloc[:0], *parts])), ignore_index=True)
        pd.testing.assert_frame_equal(got, want)


def test_bytes_and_bits_choose_the_same(monkeypatch):
    r = np.random.default_rng(6)
    prices, values = r.integers(0, 30, 80).tolist(), r.integers(1, 4, 80).tolist()
    for spend in (None, 17, 90):
        got = []
        for trace in (64 << 20, 80 * 100 // 8, 50):
            monkeypatch.setattr(knapsack, "TRACE_BYTES", trace)
            got.append(knapsack._choose(prices, values, 0, 80, np.zeros(100, dtype=np.int64), spend))
        assert got[0] == got[1] == got[2]


def test_no_data_frame_for_each_hospital(spark):
    items = spark.createDataFrame([(h, d, 1 + d % 3, 1 + d % 5, 9) for h in range(5) for d in range(20)],
                                  "hospital_id long, doctor_id long, utility long, price long, budget long")
    plan = knapsack.knapsack_select(items)._jdf.queryExecution().toString()
    assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan
