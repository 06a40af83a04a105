"""Column expressions shared by the operators.

All are built-in Spark expressions (JVM side, inside whole-stage codegen).
Two division policies exist because the reference's two paths disagree:

* ``ratio``      -- SQL policy: NULL when the denominator is 0 or NULL.
* ``safe_ratio`` -- dataframe policy: 0.0 when the denominator is 0/NULL.

Spark 4 runs with ANSI on, so a bare ``x / 0`` raises; every division in the
library goes through one of these two helpers.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL_MONEY = T.DecimalType(38, 2)

# Fixed values that must equal the reference's definitions.
# Severity bands of days of inventory: (-1, 0] Critical, (0, 2] High, (2, 5] Medium.
SEVERITY_BANDS = (("Critical", -1.0, 0.0), ("High", 0.0, 2.0), ("Medium", 2.0, 5.0))
# Supplier risk tier penalty: Low 0.0, Medium 0.15, High 0.30 (unknown tier 0.0).
TIER_PENALTY = {"Low": 0.0, "Medium": 0.15, "High": 0.30}
# Resilience score weights: 0.60 service failure, 0.25 backorder share, 0.15 tier.
RISK_WEIGHTS = (0.60, 0.25, 0.15)
# Cover threshold of the stockout exception list, in days of demand.
EXCEPTION_COVER_DAYS = 5


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: str | Column) -> Column:
    return col(c).cast(T.DoubleType())


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (SQL ``nullif`` policy)."""
    d = as_double(den)
    return F.when(d != 0, as_double(num) / d)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE; 0.0 when den is 0 or NULL (dataframe policy)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def flag_int(c: str | Column) -> Column:
    """Boolean as 0/1 (NULL stays NULL)."""
    return col(c).cast(T.LongType())


def flag_rate(c: str | Column) -> Column:
    """Share of TRUE among non-NULL flags, computed from exact integer sums."""
    return ratio(F.sum(flag_int(c)), F.count(col(c)))


def money(c: str | Column, dtype: T.DecimalType = MONEY) -> Column:
    return col(c).cast(dtype)


def cents_to_money(cents: str | Column, dtype: T.DecimalType = MONEY) -> Column:
    """Integer cents to DECIMAL by multiplying by 0.01 (never dividing decimals)."""
    return (col(cents).cast(T.DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(dtype)


def isclose(a: str | Column, b: str | Column, rel_tol: float = 1e-9, abs_tol: float = 1e-9) -> Column:
    """``math.isclose`` semantics; NULL or NaN on either side is not close."""
    a, b = as_double(a), as_double(b)
    bound = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    ok = (F.abs(a - b) <= bound) & ~F.isnan(a) & ~F.isnan(b)
    return F.coalesce(ok, F.lit(False))


def is_finite(c: str | Column) -> Column:
    """TRUE only for a real, finite number (NULL, NaN and +/-Infinity are FALSE)."""
    x = as_double(c)
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def holds(predicate: Column) -> Column:
    """A row predicate that treats NULL (and hence NaN-free NULL inputs) as a violation."""
    return F.coalesce(predicate, F.lit(False))


def non_negative(c: str | Column) -> Column:
    """``x >= 0`` where NULL and NaN fail, as in a dataframe ``>= 0`` test."""
    x = col(c)
    return holds((x >= 0) & ~F.isnan(as_double(x)))


def severity(days_of_inventory: str | Column) -> Column:
    """Right-closed bands of days of cover; outside every band gives NULL."""
    d = col(days_of_inventory)
    expr = None
    for label, lo, hi in SEVERITY_BANDS:
        cond = (d > lo) & (d <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def severity_rank(label: str | Column) -> Column:
    """Category order of the severity bands (1 = most severe); NULL stays NULL."""
    lab = col(label)
    expr = None
    for rank, (name, _, _) in enumerate(SEVERITY_BANDS, start=1):
        expr = F.when(lab == name, F.lit(rank)) if expr is None else expr.when(lab == name, F.lit(rank))
    return expr.cast(T.IntegerType())


def tier_penalty(tier: str | Column) -> Column:
    t = col(tier)
    expr = None
    for name, penalty in TIER_PENALTY.items():
        expr = F.when(t == name, F.lit(penalty)) if expr is None else expr.when(t == name, F.lit(penalty))
    return expr.otherwise(F.lit(0.0))


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out
