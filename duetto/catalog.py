"""Registered queries on the driver tables and their DuckDB oracle SQL.

Market on the driver tables: doctors are customers, hospitals are suppliers,
one edge per (customer, supplier) pair that shares a line item.  Customers rank
suppliers by total quantity bought (most first).  Suppliers rank customers by
their largest line price (market "price") or by total quantity, least first
(market "contested", where doctor- and hospital-optimal matchings differ).
Quota 6 everywhere, ranks 1-based.

"State" below is round 2 of doctor-proposing deferred acceptance with
``STATE_QUOTA`` places: every customer has proposed to its first choice, and
those it refused to their second.  Some suppliers are full and others have free
places, some customers hold their second choice and others nothing, so that
every branch of the row operators and of the blocking-pair check has rows.

Each query function takes (spark, sf_dir) and returns a DataFrame whose
integral columns are bigint; the SQL casts to the same names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duetto.functions.terms import contract_terms
from duetto.names import DOCTOR, DOCTOR_RANK, EDGE_COLUMNS, HOSPITAL, HOSPITAL_RANK
from duetto.operators import aggregates as agg
from duetto.operators import filters as flt
from duetto.operators import joins as jn
from duetto.operators import reshape as rs
from duetto.operators import verify as vf
from duetto.operators.knapsack import knapsack_select
from duetto.operators.ranking import rank_within, rejected_applicants, top_n_per_group
from duetto.plans.contracts import match_contracts
from duetto.plans.doctor_optimal import held_proposals, match_doctor_optimal, proposals
from duetto.plans.hospital_optimal import match_hospital_optimal
from duetto.plans.report import (append_trace, convergence_report, label_trace, read_traces,
                                 running_changes)
from duetto.session import cut_lineage, ensure_checkpoint_dir, scratch_path
from duetto.sources.market import order_lines, read_table, tpch_market
from duetto.sources.sinks import write_matching
from duetto.sources.synth import generate_preferences
from duetto.sources.text import (read_market_text, read_preferences_rescued, read_preferences_text,
                                 write_market_text, write_preferences_text)

QUOTA = 6
STATE_QUOTA = 20
CONTRACT_ROUNDS = 4         # the rounds that the registered query shows, see there
SYNTH_CHOICES = 10
SYNTH_SEED = 42

# ---------------------------------------------------------------------------
# shared, memoised inputs (per Spark context and data folder)
# ---------------------------------------------------------------------------

_MEMO: dict[tuple, object] = {}


def _memo(spark: SparkSession, key: tuple, build: Callable[[], object]):
    # The application id is unique per SparkContext (an object id may be
    # reused after a context stops).
    k = (spark.sparkContext.applicationId,) + key
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def bigint_out(df: DataFrame) -> DataFrame:
    """Cast every integral column to bigint (the oracle's integer type)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def market(spark: SparkSession, sf_dir: str, variant: str = "price") -> DataFrame:
    ensure_checkpoint_dir(spark)
    return _memo(spark, ("market", sf_dir, variant),
                 lambda: cut_lineage(tpch_market(spark, sf_dir, variant)))


def hospital_optimal(spark, sf_dir, variant="price", trace=False):
    return _memo(spark, ("I2", sf_dir, variant, trace),
                 lambda: match_hospital_optimal(market(spark, sf_dir, variant),
                                                QUOTA, trace=trace, local=not trace))


def doctor_optimal(spark, sf_dir, variant="price", trace=False):
    return _memo(spark, ("I1", sf_dir, variant, trace),
                 lambda: match_doctor_optimal(market(spark, sf_dir, variant),
                                              QUOTA, trace=trace, local=not trace))


def first_proposals(spark, sf_dir) -> DataFrame:
    return proposals(market(spark, sf_dir))


def first_round_state(spark, sf_dir) -> DataFrame:
    """Held proposals after round 1 (an unstable matching)."""
    return _memo(spark, ("state1", sf_dir), lambda: cut_lineage(
        held_proposals(first_proposals(spark, sf_dir), QUOTA, QUOTA)
        .select(*EDGE_COLUMNS)))


def second_round_state(spark, sf_dir) -> DataFrame:
    """Held proposals after round 2 with ``STATE_QUOTA`` places."""
    def build() -> DataFrame:
        refused = rejected_applicants(first_proposals(spark, sf_dir), HOSPITAL, HOSPITAL_RANK,
                                      STATE_QUOTA, key=[DOCTOR, HOSPITAL])
        rest = market(spark, sf_dir).join(refused.select(DOCTOR, HOSPITAL),
                                          [DOCTOR, HOSPITAL], "left_anti")
        return cut_lineage(held_proposals(proposals(rest), STATE_QUOTA, STATE_QUOTA)
                           .select(*EDGE_COLUMNS))
    return _memo(spark, ("state2", sf_dir), build)


def supplier_quotas(spark, sf_dir) -> DataFrame:
    """A quota table with 0 to 8 places, null for some and none for others."""
    key = F.col("s_suppkey")
    return (read_table(spark, sf_dir, "supplier").where(key % 10 != 9)
            .select(key.alias(HOSPITAL), F.when(key % 10 != 8, key % 9).cast("int").alias("quota")))


def broken_matching(spark, sf_dir) -> DataFrame:
    """A matching with every kind of fault: the hospital-optimal one, and for
    every third of its doctors a second place at the next hospital, which takes
    the doctor whether they list each other or not."""
    good = hospital_optimal(spark, sf_dir).matching
    more = good.where(F.col(DOCTOR) % 3 == 0).withColumn(HOSPITAL, F.col(HOSPITAL) + 1)
    return good.unionByName(more)


def customers(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(DOCTOR))


def suppliers(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias(HOSPITAL))


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def q_market_edges(spark, sf_dir):
    return bigint_out(market(spark, sf_dir))


def q_match_hospital_optimal(spark, sf_dir):
    return bigint_out(hospital_optimal(spark, sf_dir).matching)


def q_match_hospital_optimal_contested(spark, sf_dir):
    return bigint_out(hospital_optimal(spark, sf_dir, "contested").matching)


def q_match_doctor_optimal(spark, sf_dir):
    return bigint_out(doctor_optimal(spark, sf_dir, "contested").matching)


def q_convergence_trace(spark, sf_dir):
    return bigint_out(hospital_optimal(spark, sf_dir, trace=True).trace(spark))


def q_convergence_trace_doctor(spark, sf_dir):
    return bigint_out(doctor_optimal(spark, sf_dir, trace=True).trace(spark))


def q_convergence_trace_doctor_plain(spark, sf_dir):
    """Changes in each of the classic rounds, one choice of a rejected doctor a round."""
    r = match_doctor_optimal(market(spark, sf_dir), QUOTA, accelerate=False, trace=True)
    return bigint_out(r.trace(spark))


def q_convergence_report(spark, sf_dir):
    i2 = hospital_optimal(spark, sf_dir, trace=True).trace(spark)
    i1 = doctor_optimal(spark, sf_dir, trace=True).trace(spark)
    traces = label_trace(i2, "hospital_optimal").unionByName(label_trace(i1, "doctor_optimal"))
    return bigint_out(convergence_report(traces))


def q_convergence_history(spark, sf_dir):
    """The report over a table to which two runs were added, one of them twice."""
    path = scratch_path(spark, "traces")
    i2 = hospital_optimal(spark, sf_dir, trace=True).trace(spark)
    for run, trace in (("hospital_optimal", i2),
                       ("doctor_optimal", doctor_optimal(spark, sf_dir, trace=True).trace(spark)),
                       ("hospital_optimal", i2)):
        append_trace(trace, run, path)
    return bigint_out(convergence_report(read_traces(spark, path)))


def q_convergence_running(spark, sf_dir):
    i2 = hospital_optimal(spark, sf_dir, trace=True).trace(spark)
    i1 = doctor_optimal(spark, sf_dir, trace=True).trace(spark)
    traces = label_trace(i2, "hospital_optimal").unionByName(label_trace(i1, "doctor_optimal"))
    return bigint_out(running_changes(traces))


def q_blocking_pairs(spark, sf_dir):
    return bigint_out(vf.blocking_pairs(market(spark, sf_dir),
                                        second_round_state(spark, sf_dir), STATE_QUOTA))


def q_stability_check(spark, sf_dir):
    good = vf.stability_check(market(spark, sf_dir),
                              hospital_optimal(spark, sf_dir).matching, QUOTA)
    bad = vf.stability_check(market(spark, sf_dir), second_round_state(spark, sf_dir), STATE_QUOTA)
    return bigint_out(good.withColumn("matching", F.lit("hospital_optimal"))
                      .unionByName(bad.withColumn("matching", F.lit("second_round"))))


def q_matching_consistency(spark, sf_dir):
    good = vf.matching_consistency(market(spark, sf_dir),
                                   hospital_optimal(spark, sf_dir).matching, QUOTA)
    bad = vf.matching_consistency(market(spark, sf_dir), broken_matching(spark, sf_dir), QUOTA)
    return bigint_out(good.withColumn("matching", F.lit("hospital_optimal"))
                      .unionByName(bad.withColumn("matching", F.lit("broken"))))


def q_match_hospital_optimal_quotas(spark, sf_dir):
    return bigint_out(match_hospital_optimal(market(spark, sf_dir),
                                             supplier_quotas(spark, sf_dir)).matching)


def q_match_doctor_optimal_quotas(spark, sf_dir):
    return bigint_out(_memo(spark, ("I1 quotas", sf_dir), lambda: match_doctor_optimal(
        market(spark, sf_dir, "contested"), supplier_quotas(spark, sf_dir))).matching)


def q_blocking_pairs_quotas(spark, sf_dir):
    return bigint_out(vf.blocking_pairs(market(spark, sf_dir), second_round_state(spark, sf_dir),
                                        supplier_quotas(spark, sf_dir)))


def q_matching_consistency_quotas(spark, sf_dir):
    return bigint_out(vf.matching_consistency(
        market(spark, sf_dir), second_round_state(spark, sf_dir), supplier_quotas(spark, sf_dir)))


def q_fill_report_quotas(spark, sf_dir):
    return bigint_out(agg.fill_report(suppliers(spark, sf_dir), second_round_state(spark, sf_dir),
                                      supplier_quotas(spark, sf_dir)))


def q_rank_within_split(spark, sf_dir):
    """Ranking by range partitions, which hot groups take: every line of a
    supplier by price."""
    lines = order_lines(spark, sf_dir).select(
        HOSPITAL, "l_orderkey", DOCTOR, "l_quantity", "l_extendedprice", "l_returnflag")
    prices = lines.groupBy(HOSPITAL, "l_orderkey").agg(F.max("l_extendedprice").alias("price"))
    ranked = rank_within(cut_lineage(prices), HOSPITAL, [F.col("price").desc(), F.col("l_orderkey")],
                         "position", split=True)
    return bigint_out(ranked.select(HOSPITAL, F.col("l_orderkey").alias("order_id"), "position"))


def q_contiguous_ids(spark, sf_dir):
    c = vf.contiguous_ids(customers(spark, sf_dir), DOCTOR).withColumn("side", F.lit("doctor"))
    s = vf.contiguous_ids(suppliers(spark, sf_dir), HOSPITAL).withColumn("side", F.lit("hospital"))
    return bigint_out(c.unionByName(s))


def q_programs_by_applicant(spark, sf_dir):
    return bigint_out(rs.invert(market(spark, sf_dir)).select(HOSPITAL, DOCTOR, HOSPITAL_RANK))


def q_explode_preferences(spark, sf_dir):
    # List form with repeats: each order's suppliers in line order.  A list
    # holds one order's lines, so it is bounded by the lines per order.
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey")))
    lists = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.transform(ordered, lambda x: x["l_suppkey"]).alias("prefs"))
    return bigint_out(rs.explode_preferences(lists, "order_id", "prefs", HOSPITAL, "position"))


def _doctor_lists(spark, sf_dir):
    return rs.collapse_preferences(market(spark, sf_dir), DOCTOR, HOSPITAL, DOCTOR_RANK)


def _list_rows(lists: DataFrame, id_col: str) -> DataFrame:
    return bigint_out(lists.select(id_col, F.size("prefs").alias("n_prefs"),
                                   rs.list_text("prefs").alias("prefs_text")))


def q_collapse_preferences(spark, sf_dir):
    return _list_rows(_doctor_lists(spark, sf_dir), DOCTOR)


def q_pref_text_roundtrip(spark, sf_dir):
    lists = rs.collapse_preferences(market(spark, sf_dir), HOSPITAL, DOCTOR, HOSPITAL_RANK)
    path = scratch_path(spark, "hospital-prefs")
    write_preferences_text(lists, HOSPITAL, path, entities=suppliers(spark, sf_dir))
    back = read_preferences_text(spark, path, HOSPITAL)
    return _list_rows(back, HOSPITAL)


def q_pref_text_rescued(spark, sf_dir):
    """Hospitals' lists read back from text in which some lines have bad tokens."""
    lists = rs.collapse_preferences(market(spark, sf_dir), HOSPITAL, DOCTOR, HOSPITAL_RANK)
    key, text = F.col(HOSPITAL), F.coalesce(rs.list_text("prefs"), F.lit(""))
    lines = suppliers(spark, sf_dir).join(lists, HOSPITAL, "left").select(HOSPITAL, F.concat(
        F.when(key % 7 == 3, F.concat(F.lit("x"), key, F.lit(" "))).otherwise(F.lit("")), text,
        F.when(key % 11 == 5, F.lit(" 99999999999999999999")).otherwise(F.lit(""))).alias("value"))
    path = scratch_path(spark, "bad-prefs")
    lines.orderBy(HOSPITAL).select("value").write.text(path)
    back = read_preferences_rescued(spark, path, HOSPITAL)
    return bigint_out(back.select(HOSPITAL, rs.list_text("prefs").alias("prefs_text"),
                                  "text", "reason", F.col("line").isNotNull().alias("has_line")))


def q_market_text_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "market-text")
    write_market_text(market(spark, sf_dir), customers(spark, sf_dir), suppliers(spark, sf_dir),
                      base + "/doctors", base + "/hospitals")
    edges, _ = read_market_text(spark, base + "/doctors", base + "/hospitals")
    return bigint_out(edges)


def q_matching_text_output(spark, sf_dir):
    path = scratch_path(spark, "matching-text")
    write_matching(hospital_optimal(spark, sf_dir).matching, path,
                   doctors=customers(spark, sf_dir), fmt="text")
    parts = F.split(F.trim(F.col("value")), " ")
    return bigint_out(spark.read.text(path).select(
        parts[0].cast("bigint").alias(DOCTOR), parts[1].cast("bigint").alias(HOSPITAL)))


def q_next_choice(spark, sf_dir):
    e = market(spark, sf_dir)
    rejected = rejected_applicants(first_proposals(spark, sf_dir), HOSPITAL, HOSPITAL_RANK,
                                   QUOTA, key=[DOCTOR, HOSPITAL])
    remaining = e.join(rejected.select(DOCTOR, HOSPITAL), [DOCTOR, HOSPITAL], "left_anti")
    return bigint_out(rs.next_choice(remaining).select(DOCTOR, HOSPITAL, DOCTOR_RANK))


def q_drop_first_choice(spark, sf_dir):
    state = second_round_state(spark, sf_dir).select(DOCTOR, HOSPITAL)
    return _list_rows(rs.drop_first_choice(_doctor_lists(spark, sf_dir), state), DOCTOR)


def q_choices_at_or_above(spark, sf_dir):
    return bigint_out(rs.choices_at_or_above(market(spark, sf_dir),
                                             second_round_state(spark, sf_dir))
                      .select(DOCTOR, HOSPITAL, DOCTOR_RANK))


def q_choices_strictly_above(spark, sf_dir):
    return bigint_out(rs.choices_strictly_above(market(spark, sf_dir),
                                                second_round_state(spark, sf_dir))
                      .select(DOCTOR, HOSPITAL, DOCTOR_RANK))


def q_candidates_above_worst(spark, sf_dir):
    return bigint_out(rs.candidates_above_worst(market(spark, sf_dir),
                                                second_round_state(spark, sf_dir)))


def q_rank_lookup(spark, sf_dir):
    state = second_round_state(spark, sf_dir).select(DOCTOR, HOSPITAL)
    j = state.join(_doctor_lists(spark, sf_dir), DOCTOR)
    return bigint_out(j.select(DOCTOR, HOSPITAL, rs.rank_lookup("prefs", HOSPITAL).alias("position")))


def q_matching_with_unmatched(spark, sf_dir):
    return bigint_out(jn.matching_with_unmatched(customers(spark, sf_dir),
                                                 second_round_state(spark, sf_dir)))


def q_matched_only(spark, sf_dir):
    full = jn.matching_with_unmatched(customers(spark, sf_dir), second_round_state(spark, sf_dir))
    state = full.select(DOCTOR, F.when(F.col(HOSPITAL) >= 0, F.col(HOSPITAL)).alias(HOSPITAL))
    return bigint_out(flt.matched_only(state))


def q_active_proposers(spark, sf_dir):
    return bigint_out(flt.active_proposers(market(spark, sf_dir), second_round_state(spark, sf_dir)))


def _state_of(docs: DataFrame, matching: DataFrame) -> DataFrame:
    """Every doctor's hospital: the initial all-unmatched state
    updated with a matching (NULL where unmatched)."""
    m = matching.select(DOCTOR, F.col(HOSPITAL).alias("_h"))
    return (rs.initial_state(docs).join(m, DOCTOR, "left")
            .select(DOCTOR, F.coalesce(F.col("_h"), F.col(HOSPITAL)).alias(HOSPITAL)))


def q_changed_matches(spark, sf_dir):
    docs = customers(spark, sf_dir)
    old = _state_of(docs, second_round_state(spark, sf_dir))
    new = _state_of(docs, hospital_optimal(spark, sf_dir).matching)
    return bigint_out(flt.changed_matches(old, new))


def q_one_sided_pairs(spark, sf_dir):
    # Doctors list the suppliers of lines that are not flagged A; suppliers the
    # customers with a line that was not returned.  Neither holds the other.
    lines = order_lines(spark, sf_dir)
    doctor_side = lines.where(F.col("l_returnflag") != "A").select(DOCTOR, HOSPITAL)
    hospital_side = lines.where(F.col("l_returnflag") != "R").select(DOCTOR, HOSPITAL)
    return bigint_out(flt.one_sided_pairs(doctor_side, hospital_side))


def q_mutual_edges(spark, sf_dir):
    lines = order_lines(spark, sf_dir)
    d = (lines.where(F.col("l_returnflag") != "A").groupBy(DOCTOR, HOSPITAL)
         .agg(F.sum("l_quantity").alias("qty")))
    h = (lines.where(F.col("l_returnflag") != "R").groupBy(DOCTOR, HOSPITAL)
         .agg(F.max("l_extendedprice").alias("top_price")))
    d = rank_within(cut_lineage(d), DOCTOR, [F.col("qty").desc(), F.col(HOSPITAL)], DOCTOR_RANK)
    h = rank_within(cut_lineage(h), HOSPITAL, [F.col("top_price").desc(), F.col(DOCTOR)],
                    HOSPITAL_RANK)
    return bigint_out(jn.mutual_edges(d.select(DOCTOR, HOSPITAL, DOCTOR_RANK),
                                      h.select(DOCTOR, HOSPITAL, HOSPITAL_RANK)))


def q_hospital_rosters(spark, sf_dir):
    return bigint_out(jn.hospital_rosters(suppliers(spark, sf_dir),
                                          hospital_optimal(spark, sf_dir).matching))


def q_group_proposals(spark, sf_dir):
    return bigint_out(agg.group_proposals(first_proposals(spark, sf_dir)))


def q_fill_report(spark, sf_dir):
    return bigint_out(agg.fill_report(suppliers(spark, sf_dir),
                                      hospital_optimal(spark, sf_dir).matching, QUOTA))


def q_worst_held_rank(spark, sf_dir):
    return bigint_out(rs.worst_held(second_round_state(spark, sf_dir)))


def q_best_offer(spark, sf_dir):
    offers = top_n_per_group(market(spark, sf_dir), HOSPITAL, HOSPITAL_RANK, QUOTA)
    return bigint_out(agg.best_offer(offers))


def q_top_n_per_group(spark, sf_dir):
    return bigint_out(top_n_per_group(first_proposals(spark, sf_dir), HOSPITAL,
                                      HOSPITAL_RANK, QUOTA)
                      .select(HOSPITAL, DOCTOR, HOSPITAL_RANK))


def q_rejected_applicants(spark, sf_dir):
    return bigint_out(rejected_applicants(first_proposals(spark, sf_dir), HOSPITAL,
                                          HOSPITAL_RANK, QUOTA, key=[DOCTOR, HOSPITAL])
                      .select(HOSPITAL, DOCTOR, HOSPITAL_RANK))


def q_union_options(spark, sf_dir):
    e = market(spark, sf_dir)
    held = first_round_state(spark, sf_dir)
    bumped = first_proposals(spark, sf_dir).join(held.select(DOCTOR), DOCTOR, "left_anti")
    new = e.join(bumped.select(DOCTOR), DOCTOR).where(F.col(DOCTOR_RANK) == 2)
    return bigint_out(agg.union_options(new, held))


def q_pair_intersection(spark, sf_dir):
    e = market(spark, sf_dir)
    state = second_round_state(spark, sf_dir)
    return bigint_out(agg.pair_intersection(rs.choices_strictly_above(e, state),
                                            rs.candidates_above_worst(e, state)))


def q_better_not_held(spark, sf_dir):
    e = market(spark, sf_dir)
    state = second_round_state(spark, sf_dir)
    return bigint_out(agg.better_not_held(rs.candidates_above_worst(e, state), state))


def q_contract_terms(spark, sf_dir):
    return bigint_out(contract_terms(market(spark, sf_dir).select(DOCTOR, HOSPITAL)))


def q_knapsack_best_value(spark, sf_dir):
    items = contract_terms(market(spark, sf_dir).select(DOCTOR, HOSPITAL))
    chosen = knapsack_select(items)
    return bigint_out(chosen.groupBy(HOSPITAL).agg(
        F.sum("utility").alias("utility"), F.sum("price").alias("spend")))


def q_match_contracts(spark, sf_dir):
    """The budgeted loop after ``CONTRACT_ROUNDS`` rounds: the limit is part of
    the query (the loop need not converge), and its outcome of the result."""
    res = match_contracts(market(spark, sf_dir), max_iter=CONTRACT_ROUNDS)
    start, length = res.cycle or (None, None)
    return bigint_out(res.matching.withColumn("rounds", F.lit(res.rounds))
                      .withColumn("converged", F.lit(res.converged))
                      .withColumn("cycle_start", F.lit(start).cast("bigint"))
                      .withColumn("cycle_length", F.lit(length).cast("bigint")))


def q_synthetic_market(spark, sf_dir):
    n_h = suppliers(spark, sf_dir).count()
    return bigint_out(generate_preferences(customers(spark, sf_dir), n_h,
                                           SYNTH_CHOICES, SYNTH_SEED))


def q_synthetic_market_distinct(spark, sf_dir):
    n_h = suppliers(spark, sf_dir).count()
    return bigint_out(generate_preferences(customers(spark, sf_dir), n_h, min(SYNTH_CHOICES, n_h),
                                           SYNTH_SEED, replace=False))


def q_match_synthetic(spark, sf_dir):
    n_h = suppliers(spark, sf_dir).count()
    e = generate_preferences(customers(spark, sf_dir), n_h, SYNTH_CHOICES, SYNTH_SEED)
    return bigint_out(match_hospital_optimal(e, QUOTA).matching)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "market_edges": q_market_edges,
    "match_hospital_optimal": q_match_hospital_optimal,
    "match_hospital_optimal_contested": q_match_hospital_optimal_contested,
    "match_doctor_optimal": q_match_doctor_optimal,
    "convergence_trace": q_convergence_trace,
    "convergence_trace_doctor": q_convergence_trace_doctor,
    "convergence_trace_doctor_plain": q_convergence_trace_doctor_plain,
    "convergence_report": q_convergence_report,
    "convergence_history": q_convergence_history,
    "convergence_running": q_convergence_running,
    "blocking_pairs": q_blocking_pairs,
    "stability_check": q_stability_check,
    "matching_consistency": q_matching_consistency,
    "match_hospital_optimal_quotas": q_match_hospital_optimal_quotas,
    "match_doctor_optimal_quotas": q_match_doctor_optimal_quotas,
    "blocking_pairs_quotas": q_blocking_pairs_quotas,
    "matching_consistency_quotas": q_matching_consistency_quotas,
    "fill_report_quotas": q_fill_report_quotas,
    "rank_within_split": q_rank_within_split,
    "contiguous_ids": q_contiguous_ids,
    "programs_by_applicant": q_programs_by_applicant,
    "explode_preferences": q_explode_preferences,
    "collapse_preferences": q_collapse_preferences,
    "pref_text_roundtrip": q_pref_text_roundtrip,
    "pref_text_rescued": q_pref_text_rescued,
    "market_text_roundtrip": q_market_text_roundtrip,
    "matching_text_output": q_matching_text_output,
    "next_choice": q_next_choice,
    "drop_first_choice": q_drop_first_choice,
    "choices_at_or_above": q_choices_at_or_above,
    "choices_strictly_above": q_choices_strictly_above,
    "candidates_above_worst": q_candidates_above_worst,
    "rank_lookup": q_rank_lookup,
    "matching_with_unmatched": q_matching_with_unmatched,
    "matched_only": q_matched_only,
    "active_proposers": q_active_proposers,
    "changed_matches": q_changed_matches,
    "one_sided_pairs": q_one_sided_pairs,
    "mutual_edges": q_mutual_edges,
    "hospital_rosters": q_hospital_rosters,
    "group_proposals": q_group_proposals,
    "fill_report": q_fill_report,
    "worst_held_rank": q_worst_held_rank,
    "best_offer": q_best_offer,
    "top_n_per_group": q_top_n_per_group,
    "rejected_applicants": q_rejected_applicants,
    "union_options": q_union_options,
    "pair_intersection": q_pair_intersection,
    "better_not_held": q_better_not_held,
    "contract_terms": q_contract_terms,
    "knapsack_best_value": q_knapsack_best_value,
    "match_contracts": q_match_contracts,
    "synthetic_market": q_synthetic_market,
    "match_synthetic": q_match_synthetic,
    "synthetic_market_distinct": q_synthetic_market_distinct,
}
