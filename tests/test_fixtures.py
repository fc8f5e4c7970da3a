"""Hand fixtures F1-F5 (expected values worked out by hand)."""

import pandas as pd
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators import filters as flt
from duetto.operators import reshape as rs
from duetto.operators import verify as vf
from duetto.operators.knapsack import knapsack_select, solve_knapsack
from duetto.operators.ranking import rejected_applicants, top_n_per_group
from duetto.plans.doctor_optimal import match_doctor_optimal
from duetto.plans.hospital_optimal import match_hospital_optimal

def market(spark, doctor_lists, hospital_lists):
    """Edges from hand-written lists (0-based ranks; mutual pairs only)."""
    d = [(i, h, r) for i, hs in doctor_lists.items() for r, h in enumerate(hs)]
    h = [(i, hid, r) for hid, ds in hospital_lists.items() for r, i in enumerate(ds)]
    dd = spark.createDataFrame(d, "doctor_id long, hospital_id long, doctor_rank int")
    hh = spark.createDataFrame(h, "doctor_id long, hospital_id long, hospital_rank int")
    return dd.join(hh, [DOCTOR, HOSPITAL])


def pairs(df):
    return sorted((r[DOCTOR], r[HOSPITAL]) for r in df.select(DOCTOR, HOSPITAL).collect())


def test_f1_top_n_per_group(spark):
    prefs = [3, 4, 5, 1, 2, 7, 8]
    options = [7, 1, 2, 4, 5]
    rows = [(0, d, prefs.index(d)) for d in options]
    df = spark.createDataFrame(rows, "hospital_id long, doctor_id long, hospital_rank int")
    top = top_n_per_group(df, HOSPITAL, HOSPITAL_RANK, 3).orderBy(HOSPITAL_RANK)
    assert [r[DOCTOR] for r in top.collect()] == [4, 5, 1]
    rej = rejected_applicants(df, HOSPITAL, HOSPITAL_RANK, 3, key=[HOSPITAL, DOCTOR])
    assert sorted(r[DOCTOR] for r in rej.collect()) == [2, 7]


def test_f2_the_two_optima_differ(spark):
    e = market(spark, {0: [0, 1], 1: [1, 0]}, {0: [1, 0], 1: [0, 1]})
    d_opt = match_doctor_optimal(e, 1)
    h_opt = match_hospital_optimal(e, 1)
    assert pairs(d_opt.matching) == [(0, 0), (1, 1)]
    assert pairs(h_opt.matching) == [(0, 1), (1, 0)]
    assert vf.blocking_pairs(e, d_opt.matching, 1).count() == 0
    assert vf.blocking_pairs(e, h_opt.matching, 1).count() == 0


def test_f3_hospital_that_loses_everybody(spark):
    e = market(spark, {0: [1, 0], 1: [0], 2: [2, 1]}, {0: [0, 1], 1: [2, 0], 2: [2]})
    want = [(0, 1), (1, 0), (2, 2)]
    assert pairs(match_doctor_optimal(e, 1).matching) == want
    assert pairs(match_doctor_optimal(e, 1, accelerate=False).matching) == want
    assert pairs(match_hospital_optimal(e, 1).matching) == want


def _items(spark, util, price, cap):
    rows = [(0, d, util[d], price[d], cap) for d in util]
    return spark.createDataFrame(rows, "hospital_id long, doctor_id long, utility long, "
                                       "price long, budget long")


def test_f4_knapsack(spark):
    util = {0: 2, 1: 3, 2: 4, 3: 2, 4: 5}
    price = {0: 1, 1: 2, 2: 3, 3: 6, 4: 1}
    got = knapsack_select(_items(spark, util, price, 3)).collect()
    assert sorted(r[DOCTOR] for r in got) == [0, 4]
    assert sum(r["utility"] for r in got) == 7 and sum(r["price"] for r in got) == 2
    # no items -> nothing chosen (no error)
    empty = solve_knapsack(pd.DataFrame({c: pd.Series(dtype="int64") for c in
                                         [HOSPITAL, DOCTOR, "utility", "price", "budget"]}))
    assert empty.empty
    # a free item of positive utility is chosen and reported
    price0 = {**price, 1: 0}
    got = knapsack_select(_items(spark, util, price0, 3)).collect()
    assert sorted(r[DOCTOR] for r in got) == [0, 1, 4]


def test_f5_text_edge_cases(spark, tmp_path):
    from duetto.sources.text import read_preferences_text
    from duetto.operators.joins import mutual_edges
    doc = tmp_path / "doctors.txt"
    hos = tmp_path / "hospitals.txt"
    # duplicate id (first position counts), padded numbers, a doctor listing
    # an unknown hospital, CRLF line ends and a blank hospital line.
    doc.write_text("    1    0    1\n    0    2\n    2    1    0\n    5    0\n", newline="")
    hos.write_bytes(b"0 1 0\r\n2 0 0\r\n\r\n")
    dl = read_preferences_text(spark, str(doc), DOCTOR)
    hl = read_preferences_text(spark, str(hos), HOSPITAL)
    got = {r[HOSPITAL]: r["prefs"] for r in hl.collect()}
    assert got == {0: [0, 1, 0], 1: [2, 0, 0], 2: []}
    de = rs.explode_preferences(dl, DOCTOR, "prefs", HOSPITAL, DOCTOR_RANK)
    he = rs.explode_preferences(hl, HOSPITAL, "prefs", DOCTOR, HOSPITAL_RANK)
    ranks = {(r[DOCTOR], r[HOSPITAL]): r[DOCTOR_RANK] for r in de.collect()}
    assert ranks[(0, 1)] == 0 and ranks[(0, 0)] == 1      # duplicate: first position
    one = {(r[DOCTOR], r[HOSPITAL], r["side"]) for r in flt.one_sided_pairs(de, he).collect()}
    assert (1, 2, "doctor") in one and (3, 0, "doctor") in one and (2, 0, "doctor") in one
    e = mutual_edges(de, he)
    m = match_doctor_optimal(e, 1).matching
    # hospital 2 ranks nobody; doctor 3 lists only hospital 0 which does not list it
    assert flt.matched_only(m).where(F.col(DOCTOR) == 3).count() == 0
    assert vf.blocking_pairs(e, m, 1).count() == 0
    # an unmatched doctor and a hospital with a free place listing each other block
    empty = m.limit(0)
    assert vf.blocking_pairs(e, empty, 1).count() == e.count()
