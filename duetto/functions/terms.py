"""Contract terms as column functions (H1-H3).

The reference defines a hospital's utility for a doctor, the doctor's minimum
price and the hospital's budget as arithmetic on the two ids.  Products of
ids overflow 64 bits on large markets (and ANSI mode raises), so every factor
is reduced modulo the result's modulus before multiplying; the value is the
same as the unreduced formula.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, HOSPITAL

# Fixed values that must equal the reference's (its contract formulas):
#   utility(d, h)   = ((d + 17) * (h + 79) * 393342739) % 200
#   min_price(d, h) = ((d + 7) * (h + 3) * 413158511) % 500
#   budget(h)       = ((h * 67867967) % 700) + 300
UTILITY_OFFSETS, UTILITY_FACTOR, UTILITY_MOD = (17, 79), 393342739, 200
PRICE_OFFSETS, PRICE_FACTOR, PRICE_MOD = (7, 3), 413158511, 500
BUDGET_FACTOR, BUDGET_MOD, BUDGET_BASE = 67867967, 700, 300


def _mulmod(factors: list[Column | int], m: int) -> Column:
    """(f1 * f2 * ...) mod m without overflow: reduce every factor first."""
    acc = F.lit(1).cast("bigint")
    for f in factors:
        c = F.lit(f % m).cast("bigint") if isinstance(f, int) else F.pmod(f.cast("bigint"), F.lit(m))
        acc = F.pmod(acc * c, F.lit(m))
    return acc


def utility(d: Column, h: Column) -> Column:
    """Hospital's utility for a doctor, 0..199 (H1)."""
    a, b = UTILITY_OFFSETS
    return _mulmod([d + a, h + b, UTILITY_FACTOR], UTILITY_MOD)


def min_price(d: Column, h: Column) -> Column:
    """Lowest price the doctor works for at the hospital, 0..499 (H2)."""
    a, b = PRICE_OFFSETS
    return _mulmod([d + a, h + b, PRICE_FACTOR], PRICE_MOD)


def budget(h: Column) -> Column:
    """Hospital's budget, 300..999 (H3).  Spend must stay below it."""
    return _mulmod([h, BUDGET_FACTOR], BUDGET_MOD) + F.lit(BUDGET_BASE)


def contract_terms(pairs: DataFrame) -> DataFrame:
    """Add ``utility``, ``price`` and ``budget`` to (doctor_id, hospital_id) rows."""
    d, h = F.col(DOCTOR), F.col(HOSPITAL)
    return pairs.withColumn("utility", utility(d, h)).withColumn(
        "price", min_price(d, h)).withColumn("budget", budget(h))
