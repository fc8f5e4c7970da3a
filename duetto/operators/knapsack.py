"""Budgeted choice per hospital (I4): 0/1 knapsack over the applicants.

A hospital picks the set of applicants with the largest total utility whose
total price stays below its budget (usable budget = budget - 1); among sets of
equal utility, the one with the smallest spend.

Spark does the heavy lifting and bounds the work per group:

* Catalyst drops applicants that can never be chosen (utility 0, or price
  at or above the budget) and takes every free applicant (price 0, utility >
  0) without any search.
* For a fixed price p a hospital can afford at most floor((budget-1)/p)
  applicants, and the best ones of a price are those with the highest
  utility (exchange argument: swapping in a better applicant of the same
  price keeps the spend and cannot lower the utility).  So a top-n per
  (hospital, price) keeps at most sum_p floor((budget-1)/p) rows per
  hospital, about budget * ln(budget), however many applied.  Of equal ones the
  larger doctor_id is better, as in the search.  The top-n is planned with a partial
  ``WindowGroupLimit``, so even a hospital holding a third of all rows is
  trimmed on every map task before its shuffle.
* The remaining, bounded groups run a numpy dynamic programme (vectorised over the
  budget axis) inside ``mapInPandas``: Spark deals the rows out by hospital and sorts
  them, and a task solves one hospital after another from slices of its batches, so
  that a small hospital costs no data frame of its own.  The way back needs a byte for
  each applicant and spend, or a bit where bytes exceed ``TRACE_BYTES``; where bits do
  too the applicants are halved until they fit, so that memory is linear in the budget.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duetto.names import DOCTOR, HOSPITAL
from duetto.operators.ranking import top_n_per_group

CHOICE_SCHEMA = T.StructType([
    T.StructField(HOSPITAL, T.LongType(), False),
    T.StructField(DOCTOR, T.LongType(), False),
    T.StructField("utility", T.LongType(), False),
    T.StructField("price", T.LongType(), False),
])

# The grouped function runs in Python workers.  Pickle this module's
# functions by value so workers need only numpy and pandas, not this package
# on their path (no --py-files needed for the solver).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Bytes of the table of decisions that one hospital's search may hold.
TRACE_BYTES = 64 << 20


def _take(dp: np.ndarray, price: int, value: int) -> np.ndarray:
    """Offers one more item to ``dp``, the best utility by spend, in place; whether it
    is taken at each spend from its price on (also on equal utility)."""
    with_it = dp[:len(dp) - price] + value
    better = with_it >= dp[price:]
    dp[price:] = np.where(better, with_it, dp[price:])
    return better


def _choose_kept(prices: list[int], values: list[int], lo: int, hi: int, dp: np.ndarray,
                 spend: int | None) -> tuple[list[int], int]:
    """:func:`_choose` with a byte for each item and spend; changes ``dp``."""
    taken, with_it = np.empty((hi - lo, len(dp)), dtype=bool), np.empty_like(dp)
    for i in range(lo, hi):
        p = prices[i]
        if p < len(dp):
            new, rest = with_it[p:], dp[p:]
            np.add(dp[:len(dp) - p], values[i], out=new)
            np.greater_equal(new, rest, out=taken[i - lo, p:])
            np.maximum(new, rest, out=rest)
    j = int(np.argmax(dp)) if spend is None else spend
    chosen = []
    for i in range(hi - 1, lo - 1, -1):
        if j >= prices[i] and taken[i - lo, j]:
            chosen.append(i)
            j -= prices[i]
    return chosen[::-1], j


def _choose(prices: list[int], values: list[int], lo: int, hi: int, dp: np.ndarray,
            spend: int | None) -> tuple[list[int], int]:
    """The items among ``lo..hi-1`` of the best choice with ``spend``, and what is spent
    on the items before; ``dp`` is the best utility by spend of those.  Without
    ``spend`` it is the smallest one of the largest utility.

    All decisions are kept, a byte each or a bit, if they fit ``TRACE_BYTES``.  Else the items
    are halved: the second half carries along, for each spend, what of it the way back
    leaves to the first half; so both halves can be searched alone, in memory that is
    linear in the budget.
    """
    if lo == hi:
        return [], int(np.argmax(dp)) if spend is None else spend
    if spend is not None:
        dp = dp[:spend + 1]         # more can't be spent
    now = dp.copy()
    if (hi - lo) * len(dp) <= TRACE_BYTES:
        return _choose_kept(prices, values, lo, hi, now, spend)
    if (hi - lo) * len(dp) <= 8 * TRACE_BYTES or hi - lo == 1:
        taken = [np.packbits(_take(now, prices[i], values[i])) if prices[i] < len(now) else None
                 for i in range(lo, hi)]
        j = int(np.argmax(now)) if spend is None else spend
        chosen = []
        for i in range(hi - 1, lo - 1, -1):
            at = j - prices[i]
            if at >= 0 and taken[i - lo][at >> 3] >> (7 - (at & 7)) & 1:
                chosen.append(i)
                j = at
        return chosen[::-1], j
    middle = (lo + hi) // 2
    for i in range(lo, middle):
        if prices[i] < len(now):
            _take(now, prices[i], values[i])
    half = now.copy()
    left = np.arange(len(now))      # what is spent before the middle
    for i in range(middle, hi):
        p = prices[i]
        if p < len(now):
            better = _take(now, p, values[i])
            left[p:] = np.where(better, left[:len(left) - p], left[p:])
    j = int(np.argmax(now)) if spend is None else spend
    before = int(left[j])
    del now, left
    second, _ = _choose(prices, values, middle, hi, half, j)
    first, rest = _choose(prices, values, lo, middle, dp, before)
    return first + second, rest


def solve_knapsack(pdf: pd.DataFrame, keep: tuple[str, ...] = ()) -> pd.DataFrame:
    """Exact 0/1 knapsack for one hospital's (bounded) candidate rows.

    Columns: hospital_id, doctor_id, utility, price, budget (+ ``keep``).
    Items are taken in doctor_id order; on equal value the later item is
    taken.  Returns the chosen rows (max utility, then min spend).
    """
    out_cols = [HOSPITAL, DOCTOR, "utility", "price", *keep]
    if pdf.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in out_cols})
    pdf = pdf.sort_values(DOCTOR, kind="stable").reset_index(drop=True)
    chosen = _best_choice(pdf["utility"].to_numpy(np.int64), pdf["price"].to_numpy(np.int64),
                          pdf["budget"].to_numpy(np.int64))
    res = pdf.iloc[chosen][out_cols].astype("int64")
    return res.reset_index(drop=True)


def _best_choice(utility: np.ndarray, price: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """Positions of the chosen ones among one hospital's applicants in doctor_id order."""
    cap = int(budget[0])                      # columns 0..cap-1: spend <= cap-1
    if (budget != cap).any():
        raise ValueError("a hospital has more than one budget")
    payable = np.flatnonzero(price < cap)
    chosen, _ = _choose(price[payable].tolist(), utility[payable].tolist(), 0, len(payable),
                        np.zeros(cap, dtype=np.int64), None)
    return payable[np.array(chosen, dtype=np.int64)]


def solve_sorted(batches: Iterator[pd.DataFrame], keep: tuple[str, ...] = ()) -> Iterator[pd.DataFrame]:
    """:func:`solve_knapsack` for all hospitals of a partition, whose rows come sorted by
    hospital and doctor.  The last hospital of a batch waits for the next one."""
    out_cols = [HOSPITAL, DOCTOR, "utility", "price", *keep]

    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        # Missing hospitals come first and are one group, as in a groupBy.
        key = rows[HOSPITAL].to_numpy()
        new = (key[1:] != key[:-1]) & ~(pd.isna(key[1:]) & pd.isna(key[:-1]))
        starts = np.flatnonzero(np.append(True, new))
        figures = [rows[c].to_numpy(np.int64) for c in ("utility", "price", "budget")]
        chosen = [a + _best_choice(*[f[a:b] for f in figures])
                  for a, b in zip(starts, np.append(starts[1:], len(rows)))]
        return rows.iloc[np.concatenate(chosen)][out_cols].astype("int64")

    waiting: list[pd.DataFrame] = []            # parts of one hospital
    for batch in batches:
        if not len(batch):
            continue
        key = batch[HOSPITAL].to_numpy()
        last = key[-1]
        same = pd.isna(key) if pd.isna(last) else key == last
        begin = int(np.argmax(same))
        if begin:
            yield solved(pd.concat([*waiting, batch.iloc[:begin]], ignore_index=True))
            waiting = []
        elif waiting and not _same_key(waiting[-1][HOSPITAL].iloc[-1], last):
            yield solved(pd.concat(waiting, ignore_index=True))
            waiting = []
        waiting.append(batch.iloc[begin:])
    if waiting:
        yield solved(pd.concat(waiting, ignore_index=True))


def _same_key(a, b) -> bool:
    return bool(a == b) or (pd.isna(a) and pd.isna(b))


def affordable(items: DataFrame) -> int:
    """The largest number of applicants of one positive price that any hospital
    can pay for (one aggregation without groups)."""
    row = items.where("price > 0 and price < budget").agg(
        F.max(F.floor((F.col("budget") - 1) / F.col("price"))).alias("n")).first()
    return int(row["n"] or 1)


def knapsack_select(items: DataFrame, keep: tuple[str, ...] = (),
                    most: int | None = None) -> DataFrame:
    """Chosen applicants per hospital.

    ``items``: hospital_id, doctor_id, utility, price, budget (all integral;
    ``budget`` constant per hospital), plus the integral columns named in
    ``keep``, which are passed through.  ``most`` is :func:`affordable` of the
    items or of a table that holds them; it is computed if not given.  Returns
    hospital_id, doctor_id, utility, price (+ ``keep``) of the chosen rows.
    """
    keep = tuple(keep)
    most = affordable(items) if most is None else most
    cand = items.select(
        F.col(HOSPITAL).cast("bigint").alias(HOSPITAL),
        F.col(DOCTOR).cast("bigint").alias(DOCTOR),
        F.col("utility").cast("bigint").alias("utility"),
        F.col("price").cast("bigint").alias("price"),
        F.col("budget").cast("bigint").alias("budget"),
        *[F.col(k).cast("bigint").alias(k) for k in keep],
    ).where((F.col("utility") > 0) & (F.col("price") < F.col("budget")))
    out = [HOSPITAL, DOCTOR, "utility", "price", *keep]
    free = cand.where(F.col("price") == 0).select(*out)
    paid = cand.where(F.col("price") > 0).withColumn(
        "_n", F.floor((F.col("budget") - 1) / F.col("price")).cast("int"))
    paid = top_n_per_group(paid, [HOSPITAL, "price"],
                           [F.col("utility").desc(), F.col(DOCTOR).desc()],
                           "_n", max_n=most).drop("_n")
    schema = T.StructType(CHOICE_SCHEMA.fields
                          + [T.StructField(k, T.LongType(), False) for k in keep])
    picked = (paid.repartition(HOSPITAL).sortWithinPartitions(HOSPITAL, F.col(DOCTOR).asc_nulls_last())
              .mapInPandas(lambda batches: solve_sorted(batches, keep), schema))
    return picked.unionByName(free)
