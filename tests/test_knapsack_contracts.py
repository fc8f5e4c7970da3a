"""Budgeted choice (I4) and matching with contracts (I3) against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from duetto.functions.terms import contract_terms
from duetto.names import DOCTOR, HOSPITAL
from duetto.operators.knapsack import knapsack_select, solve_knapsack
from duetto.plans.common import NotConverged
from duetto.plans.contracts import match_contracts


def test_knapsack_matches_brute_force(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for h in range(12):
        cap = rng.randint(5, 40)
        items = [(d, rng.randint(0, 20), rng.randint(0, 25)) for d in range(rng.randint(0, 11))]
        rows += [(h, d, v, p, cap) for d, v, p in items]
        ok = [(v, p) for _, v, p in items if v > 0 and p < cap]
        if ok:
            want[h] = bf.knapsack_value(ok, cap)
    df = spark.createDataFrame(rows, "hospital_id long, doctor_id long, utility long, "
                                     "price long, budget long")
    got = {r[HOSPITAL]: (r["u"], r["s"]) for r in knapsack_select(df).groupBy(HOSPITAL)
           .agg(F.sum("utility").alias("u"), F.sum("price").alias("s")).collect()}
    assert got == want


def test_knapsack_prefilter_keeps_optimum_with_many_cheap_items(spark):
    # 300 applicants of price 1 and budget 10: only 9 can be paid; the top-n
    # per (hospital, price) keeps the 9 most useful (six of utility 50, then
    # three of 49).
    rows = [(0, d, 1 + d % 50, 1, 10) for d in range(300)]
    df = spark.createDataFrame(rows, "hospital_id long, doctor_id long, utility long, "
                                     "price long, budget long")
    got = knapsack_select(df).collect()
    assert len(got) == 9 and sum(r["utility"] for r in got) == 6 * 50 + 3 * 49


def _serial_contracts(edges, terms, rounds):
    """Reference loop: apply at or above the match, knapsack per hospital,
    best acceptance per doctor."""
    prefs = {}
    for d, h, dr, hr in edges:
        prefs.setdefault(d, {})[h] = dr
    match = {}
    changes = []
    for _ in range(rounds):
        apps = {}
        for d, hs in prefs.items():
            for h, dr in hs.items():
                if d not in match or dr <= prefs[d][match[d]]:
                    apps.setdefault(h, []).append(d)
        accepted = {}
        for h, ds in apps.items():
            cap = terms[(ds[0], h)][2]
            cands = sorted(d for d in ds if terms[(d, h)][0] > 0 and terms[(d, h)][1] < cap)
            best, best_set = (0, 0), ()
            import itertools
            for r in range(len(cands) + 1):
                for sub in itertools.combinations(cands, r):
                    s = sum(terms[(d, h)][1] for d in sub)
                    v = sum(terms[(d, h)][0] for d in sub)
                    # of equal value and spend, the set with the later doctors
                    if s <= cap - 1 and (v, -s, sub[::-1]) > (best[0], -best[1], best_set[::-1]):
                        best, best_set = (v, s), sub
            for d in best_set:
                accepted.setdefault(d, []).append(h)
        new = {d: min(hs, key=lambda h: prefs[d][h]) for d, hs in accepted.items()}
        changes.append(sum(1 for d in set(new) | set(match) if new.get(d) != match.get(d)))
        match = new
        if changes[-1] == 0:
            break
    return match, changes


def test_contracts_loop_matches_serial_loop(spark):
    # Small market; of equal sets, both take the later doctors.
    rng = random.Random(9)
    rows = []
    for d in range(14):
        hs = rng.sample(range(4), 3)
        rows += [(d, h, r) for r, h in enumerate(hs)]
    hr = {}
    for d, h, _ in rows:
        hr.setdefault(h, []).append(d)
    edges = [(d, h, r, sorted(hr[h], key=lambda x: (x * 7919) % 31).index(d)) for d, h, r in rows]
    e = spark.createDataFrame(edges, "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    t = {(r[DOCTOR], r[HOSPITAL]): (r["utility"], r["price"], r["budget"])
         for r in contract_terms(e).collect()}
    res = match_contracts(e, max_iter=6)
    got = {r[DOCTOR]: r[HOSPITAL] for r in res.matching.collect()}
    want, changes = _serial_contracts(edges, t, 6)
    assert got == want
    assert res.changes == changes


def test_contracts_tolerance_and_round_cap(spark):
    rng = random.Random(5)
    rows = []
    for d in range(30):
        hs = rng.sample(range(5), 3)
        rows += [(d, h, r, (d * 7 + h * 3) % 31) for r, h in enumerate(hs)]
    e = spark.createDataFrame(rows, "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    loose = match_contracts(e, max_iter=5, tolerance=10 ** 9)
    assert loose.rounds == 1 and len(loose.changes) == 1
    assert loose.converged == (loose.changes[0] == 0)
    capped = match_contracts(e, max_iter=2)
    assert capped.rounds <= 2 and len(capped.changes) == capped.rounds
    if capped.rounds == 2 and capped.changes[-1] != 0:
        assert not capped.converged


ITEM = "hospital_id long, doctor_id long, utility long, price long, budget long"


def test_knapsack_has_no_budget_cap(spark):
    # 1,500 doctors of price 1 and budget 2001 can all be paid.
    df = spark.createDataFrame([(0, d, 1 + d % 7, 1, 2001) for d in range(1500)], ITEM)
    assert knapsack_select(df).count() == 1500


def test_knapsack_prefers_the_later_doctor_with_and_without_the_prefilter(spark):
    df = spark.createDataFrame([(0, d, 5, 1, 3) for d in range(3)], ITEM)
    alone = sorted(solve_knapsack(df.toPandas())["doctor_id"])
    assert sorted(r[DOCTOR] for r in knapsack_select(df).collect()) == alone == [1, 2]
    rng = random.Random(4)
    rows = [(h, d, rng.randint(1, 6), rng.randint(0, 5), 15 + h) for h in range(6) for d in range(40)]
    df = spark.createDataFrame(rows, ITEM)
    got = sorted((r[HOSPITAL], r[DOCTOR]) for r in knapsack_select(df).collect())
    want = []
    for h in range(6):
        part = df.toPandas().query(f"hospital_id == {h}")
        want += [(h, d) for d in solve_knapsack(part)["doctor_id"]]
    assert got == sorted(want)


def test_two_budgets_of_a_hospital_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, 5, 1, 3), (0, 2, 5, 1, 4)], ITEM)
    with pytest.raises(Exception, match="more than one budget"):
        knapsack_select(df).collect()


def test_contracts_that_repeat_a_matching_raise_or_end(spark):
    # Without a limit the loop ends at zero changes or at a matching that came before.
    rng = random.Random(8)
    rows = [(d, h, r, (d * 7 + h * 3) % 31) for d in range(20)
            for r, h in enumerate(rng.sample(range(4), 3))]
    e = spark.createDataFrame(rows, "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    try:
        assert match_contracts(e).converged
    except NotConverged as err:
        assert "came before" in str(err)


def full_table(pdf):
    """The choice by a table of all decisions: items in order, later ones on equal utility."""
    pdf = pdf.sort_values(DOCTOR, kind="stable")
    cap = int(pdf["budget"].iloc[0])
    items = [(int(p), int(v)) for p, v in zip(pdf["price"], pdf["utility"])]
    dp, taken = [0] * cap, []
    for p, v in items:
        row = [j >= p and dp[j - p] + v >= dp[j] for j in range(cap)]
        dp = [dp[j - p] + v if row[j] else dp[j] for j in range(cap)]
        taken.append(row)
    j, chosen = dp.index(max(dp)), []
    for i in range(len(items) - 1, -1, -1):
        if taken[i][j]:
            chosen.append(int(pdf["doctor_id"].iloc[i]))
            j -= items[i][0]
    return chosen[::-1]


@pytest.mark.parametrize("trace", [1, 4, 40, 64 << 20])
def test_any_memory_gives_the_choice_of_the_full_table(monkeypatch, trace):
    import pandas as pd

    from duetto.operators import knapsack
    monkeypatch.setattr(knapsack, "TRACE_BYTES", trace)
    for seed in range(60):
        rng = random.Random(seed)
        cap, top = rng.randint(1, 60), rng.choice([2, 6, 70])
        rows = [(0, d, rng.randint(0, top), rng.randint(0, top), cap) for d in range(rng.randint(1, 45))]
        pdf = pd.DataFrame(rows, columns=["hospital_id", "doctor_id", "utility", "price", "budget"])
        assert solve_knapsack(pdf)["doctor_id"].tolist() == full_table(pdf)


def test_memory_is_linear_in_the_budget():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from duetto.operators import knapsack
    rng, n, cap = np.random.default_rng(6), 4000, 200_000      # a bit each: 100 MB
    pdf = pd.DataFrame({"hospital_id": 0, "doctor_id": np.arange(n), "utility": rng.integers(1, 1000, n),
                        "price": rng.integers(1, 2000, n), "budget": cap})
    tracemalloc.start()
    got = solve_knapsack(pdf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < knapsack.TRACE_BYTES + 16 * 8 * cap
    assert 0 < got["price"].sum() < cap
    # No item that was left fits beside, or is better than, a dearer one that was chosen.
    left = pdf[~pdf["doctor_id"].isin(got["doctor_id"])]
    room = cap - 1 - got["price"].sum()
    assert not (left["price"] <= room).any()
    worst = got.groupby("price")["utility"].min()
    best = left.groupby("price")["utility"].max()
    assert all(best[p] <= worst[p] for p in worst.index.intersection(best.index))


def test_a_cycle_of_two_matchings_is_named(spark):
    lists = {0: [2, 1, 0], 1: [1, 2, 0], 2: [0, 1, 2]}
    budget = {0: 4, 1: 6, 2: 4}
    terms = {(0, 0): (7, 1), (0, 1): (7, 1), (0, 2): (3, 3), (1, 0): (5, 3), (1, 1): (1, 3), (1, 2): (4, 3),
             (2, 0): (1, 2), (2, 1): (5, 3), (2, 2): (4, 3)}
    e = spark.createDataFrame([(d, h, r + 1, d + 1) for d, hs in lists.items() for r, h in enumerate(hs)],
                              "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    t = spark.createDataFrame([(d, h, u, p, budget[h]) for (d, h), (u, p) in terms.items()],
                              "doctor_id long, hospital_id long, utility long, price long, budget long")
    got = match_contracts(e, max_iter=10, terms=t)
    assert got.cycle == (1, 2) and got.rounds == 10 and not got.converged
    assert match_contracts(e, max_iter=2, terms=t).cycle is None
    with pytest.raises(NotConverged, match="2 rounds ago"):
        match_contracts(e, terms=t)
