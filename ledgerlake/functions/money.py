"""Money and amount expressions (PRJ7, PRJ13) and the reconcile tolerance.

Amounts stay decimal end to end.  ``F.round`` on a decimal rounds half away from
zero (2.345 -> 2.35, -2.345 -> -2.35), which is the reference's ``ROUND(x::numeric, 2)``;
rounding a double would not be.  Ratios (percentages, scale factors) are reported as
doubles computed from the decimals: they are measures, not money.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import RECONCILE_TOLERANCE  # noqa: F401  (re-exported)

SUM_TYPE = "decimal(38,6)"


def money(c: Column | str, scale: int = 2) -> Column:
    """PRJ13: ``ROUND(x::numeric, scale)`` on a decimal column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, scale)


def as_sum(c: Column | str) -> Column:
    """Widen an amount to the type every summed output uses, decimal(38,6)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(SUM_TYPE)


def zero() -> Column:
    return F.lit(0).cast(SUM_TYPE)


def payment_amount(pay: Column | str, cash: Column | str) -> Column:
    """PRJ7: PaymentAmount when non-zero, else CashAmount; NULL counts as 0; sign kept."""
    p = F.coalesce(F.col(pay) if isinstance(pay, str) else pay, F.lit(0))
    c = F.coalesce(F.col(cash) if isinstance(cash, str) else cash, F.lit(0))
    return F.when(p != 0, p).otherwise(c)


def ratio(num: Column, den: Column, scale: float | None = None) -> Column:
    """``num / den`` as a double; NULL when ``den`` is 0 or NULL (``try_divide``)."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r * F.lit(scale) if scale is not None else r


def within_tolerance(drift: Column, tol: str = RECONCILE_TOLERANCE) -> Column:
    """``|drift| <= tol`` (inclusive), decided on the unrounded drift."""
    return F.abs(drift) <= F.lit(tol).cast("decimal(10,6)")
