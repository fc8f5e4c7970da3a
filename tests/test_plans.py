"""Physical plan shapes the scale design relies on (checked with explain).

* A matching round reads the laid-out edges with no exchange and no sort
  below its first window: the layout survives the checkpoint, the cache and
  the anti join with the state.
* Top-n steps trim every partition before their shuffle (partial
  WindowGroupLimit).
* Beyond the broadcast budget only the small state is shuffled, never the
  edges.
"""

import pytest
from pyspark.sql import functions as F

from duetto.functions.terms import contract_terms
from duetto.names import DOCTOR, HOSPITAL, HOSPITAL_RANK
from duetto.operators.knapsack import affordable, knapsack_select
from duetto.plans import doctor_optimal as D
from duetto.plans.hospital_optimal import (layout, match_hospital_optimal,
                                            remaining_edges, round_offers)
from duetto.session import pin_layout
from duetto.sources.synth import generate_preferences


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _below(plan: str, marker: str) -> list[str]:
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    return lines[at + 1:]


def _edges(spark):
    docs = spark.range(300).select(F.col("id").alias(DOCTOR))
    return generate_preferences(docs, 20, 6, 5)


def test_hospital_optimal_round_reads_edges_without_exchange_or_sort(spark):
    e = pin_layout(layout(_edges(spark), 8))
    state = round_offers(e, 6, 6).checkpoint()
    plan = _plan(round_offers(remaining_edges(e, state, 120), 6, 6))
    below = _below(plan, "row_number(), 6, Partial")
    assert "BroadcastHashJoin" in "\n".join(below)
    assert not [x for x in below if "Exchange hashpartitioning" in x or "Sort [" in x]
    # one shuffle per round: the trimmed top-n rows, by hospital
    assert plan.count("Exchange hashpartitioning") == 1
    e.unpersist()


def test_doctor_optimal_round_reads_edges_without_exchange_or_sort(spark):
    e = pin_layout(D._layout(_edges(spark), 8))
    plan = _plan(D.held_proposals(D.proposals(e), 6, 6))
    below = _below(plan, "row_number(), 1, Final")
    assert not [x for x in below if "Exchange" in x or "Sort [" in x]
    assert "row_number(), 6, Partial" in plan
    e.unpersist()


def test_state_beyond_broadcast_budget_is_shuffled_not_the_edges(spark):
    e = pin_layout(layout(_edges(spark), 8, by_doctor=True))
    state = round_offers(e, 6, 6).checkpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = _plan(round_offers(remaining_edges(e, state, 120), 6, 6))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = _below(plan, "row_number(), 6, Partial")
    text = "\n".join(below)
    assert "ShuffledHashJoin" in text and "BroadcastHashJoin" not in text
    exchanges = [x for x in below if "Exchange hashpartitioning" in x]
    assert exchanges and all("_d#" in x for x in exchanges)     # only the state moves
    assert not [x for x in below if "Sort [" in x]
    e.unpersist()


@pytest.mark.parametrize("n_parts", [8, 200, 1000])
def test_rows_shuffled_per_round_do_not_grow_with_the_partitions(spark, n_parts):
    # What passes a partition's trim is what a round shuffles.
    docs = spark.range(3000).select(F.col("id").alias(DOCTOR))
    e = pin_layout(layout(generate_preferences(docs, 30, 12, 5), n_parts))
    offers = None
    for _ in range(3):
        live = remaining_edges(e, offers, 180)
        passed = (live.groupBy(F.spark_partition_id().alias("p"), HOSPITAL).count()
                  .agg(F.sum(F.least("count", F.lit(6))).alias("n")).first()["n"])
        assert 0 < passed <= 6 * 30
        offers = round_offers(live, 6, 6).checkpoint()
    e.unpersist()


@pytest.mark.parametrize("n_parts", [8, 200])
def test_matching_and_rounds_are_the_same_for_any_layout(spark, n_parts):
    e = _edges(spark).checkpoint()
    rows = lambda m: sorted((r[DOCTOR], r[HOSPITAL]) for r in m.matching.collect())
    one = match_hospital_optimal(e, 4, trace=True, n_parts=4)
    two = match_hospital_optimal(e, 4, trace=True, n_parts=n_parts)
    assert (rows(one), one.rounds, one.changes) == (rows(two), two.rounds, two.changes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")      # by doctor
    try:
        three = match_hospital_optimal(e, 4, trace=True, n_parts=4)
        assert (rows(three), three.changes) == (rows(one), one.changes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_knapsack_trims_before_its_shuffle(spark):
    items = contract_terms(_edges(spark).select(DOCTOR, HOSPITAL))
    plan = _plan(knapsack_select(items))
    below = _below(plan, f"row_number(), {affordable(items)}, Partial")
    assert not [x for x in below if "Exchange hashpartitioning" in x]


def hot_market(spark):
    """Doctor 0 lists every hospital: a third of all edges."""
    rows = [(0, h, h + 1, 1 + h % 7) for h in range(60)]
    rows += [(d, (7 * d + k) % 60, k + 1, 8 + d) for d in range(1, 41) for k in range(3)]
    return spark.createDataFrame(rows, "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")


@pytest.mark.parametrize("threshold", ["10485760", "100"])
def test_a_hot_doctor_is_in_several_partitions(spark, monkeypatch, threshold):
    from duetto.plans import contracts
    import bruteforce as bf
    e = hot_market(spark).cache()
    rows = [tuple(r) for r in e.collect()]
    plain = contracts.match_contracts(e, max_iter=4)
    monkeypatch.setattr(D, "LIST_BLOCK", 8)
    monkeypatch.setattr(contracts, "LIST_BLOCK", 8)
    laid = pin_layout(D._layout(e, 8, blocks=True))
    parts = laid.where("doctor_id = 0").select(F.spark_partition_id()).distinct().count()
    assert parts > 3
    laid.unpersist()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        got = D.match_doctor_optimal(e, 1)
        assert {r[DOCTOR]: r[HOSPITAL] for r in got.matching.collect()} == bf.doctor_proposing(rows, 1)
        blocked = contracts.match_contracts(e, max_iter=4)
        assert sorted(blocked.matching.collect()) == sorted(plain.matching.collect())
        assert blocked.changes == plain.changes
    finally:
        spark.conf.set(key, before)
