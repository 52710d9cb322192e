"""Billing-cycle, date-range and period-key expressions (PRJ6, PRJ11, PRJ12, FLT1-4, FLT8, FLT10).

All helpers return Columns built from Spark's own functions, so they stay inside
whole-stage codegen and are constant-folded when given literal dates.  ``as_of``
replaces the reference's ambient ``CURRENT_DATE``.

Format notes: Spark datetime patterns use lower-case ``y`` (``YYYY`` raises), and
the ISO week-year / week are ``extract(YEAROFWEEK)`` and ``weekofyear``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import MAX_CUSTOM_RANGE_MONTHS
from ..fixed_values import REPORT_TYPES as FIXED_REPORT_TYPES

DateLike = "dt.date | str | Column"


def _date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def cycle_of(d) -> Column:
    """``YYYY-MM`` of a date (``to_char(d, 'YYYY-MM')``)."""
    return F.date_format(_date(d), "yyyy-MM")


def normalize_cycle(c: Column | str) -> Column:
    """PRJ6: ``YYYYMM`` -> ``YYYY-MM``; other strings unchanged (then checked by FLT10)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(col), r"^(\d{4})(\d{2})$", "$1-$2")


def valid_cycle(c: Column | str) -> Column:
    """FLT10: true when the cycle is a zero-padded ``yyyy-MM`` month.

    Stricter than Python's ``%Y-%m`` on purpose: ``2025-2`` would never match an
    equality on a padded cycle, so it is rejected here.
    """
    col = F.col(c) if isinstance(c, str) else c
    return (
        F.coalesce(col.rlike(r"^\d{4}-\d{2}$"), F.lit(False))
        & F.try_to_timestamp(col, F.lit("yyyy-MM")).isNotNull()
    )


def cycle_start(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.concat(col, F.lit("-01")))


def month_end(c: Column | str) -> Column:
    """PRJ12: last calendar day of a ``YYYY-MM`` cycle."""
    return F.last_day(cycle_start(c))


def in_month(date_col: Column | str, cycle) -> Column:
    """FLT1 as a half-open range so the predicate reaches the Parquet scan.

    ``TO_CHAR(bill_date,'YYYY-MM') = cycle`` only pushes ``IsNotNull``; a range on the
    bare column is pushed down and prunes row groups.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    if isinstance(cycle, str):
        start = dt.date.fromisoformat(cycle + "-01")
        end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return (d >= F.lit(start)) & (d < F.lit(end))
    first = cycle_start(cycle)
    return (d >= first) & (d < F.add_months(first, 1))


def last_days(date_col: Column | str, as_of, n: int = 30) -> Column:
    """FLT2: ``date >= as_of - n days`` (inclusive, no upper bound)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return d >= F.date_sub(_date(as_of), n)


def stored_in_month(date_col: str, month_col: str, cycle: str) -> Column:
    """FLT1 on a table partitioned by booking month: its partition, and the dates."""
    return (F.col(month_col) == F.lit(cycle)) & in_month(date_col, cycle)


def stored_last_days(date_col: str, month_col: str, as_of, n: int = 30) -> Column:
    """FLT2 on a table partitioned by booking month: the months from that of the first day on, and the dates."""
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    first = day - dt.timedelta(days=n)
    return (F.col(month_col) >= F.lit(first.strftime("%Y-%m"))) & last_days(date_col, as_of, n)


def last_cycles(cycle_col: Column | str, as_of, n: int = 12) -> Column:
    """FLT3: string compare ``cycle >= to_char(as_of - n months, 'YYYY-MM')``."""
    c = F.col(cycle_col) if isinstance(cycle_col, str) else cycle_col
    return c >= cycle_of(F.add_months(_date(as_of), -n))


def prior_cycles_booked(cycle_col: str, date_col: str, as_of) -> Column:
    """FLT4: cycle in {as_of-1 month, as_of-13 months} and date inside the as_of month."""
    a = _date(as_of)
    first = F.trunc(a, "month")
    return (
        F.col(cycle_col).isin(cycle_of(F.add_months(a, -1)), cycle_of(F.add_months(a, -13)))
        & (F.col(date_col) >= first)
        & (F.col(date_col) < F.add_months(first, 1))
    )


MAX_RANGE_MONTHS = MAX_CUSTOM_RANGE_MONTHS


def cycle_range(cycle_col: Column | str, start: str, end: str, limit: int = MAX_RANGE_MONTHS) -> Column:
    """FLT8: ``start <= cycle <= end``; a range wider than ``limit`` months is refused
    before any plan is built."""
    s = dt.date.fromisoformat(start + "-01")
    e = dt.date.fromisoformat(end + "-01")
    months = (e.year - s.year) * 12 + (e.month - s.month) + 1
    if months < 1:
        raise ValueError(f"empty cycle range {start}..{end}")
    if months > limit:
        raise ValueError(f"cycle range {start}..{end} spans {months} months; at most {limit}")
    c = F.col(cycle_col) if isinstance(cycle_col, str) else cycle_col
    return c.between(F.lit(start), F.lit(end))


# --------------------------------------------------------------------- period keys
def iso_week_key(d) -> Column:
    """``IYYY-Www``: ISO week-year and zero-padded ISO week (2027-01-01 -> 2026-W53)."""
    d = _date(d)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
    )


def quarter_key(d) -> Column:
    """``YYYY-Qn`` with n = (month - 1) div 3 + 1."""
    d = _date(d)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def year_key(d) -> Column:
    return F.year(_date(d)).cast("string")


# Report types of the aggregate table (fixed), plus last_quarter (named by the UI
# checklist; its key form is ours: YYYY-Qn).
REPORT_TYPES = FIXED_REPORT_TYPES + ("last_quarter",)


def period_keys_for(as_of) -> list[tuple[str, Column]]:
    """PRJ11: the (report_type, period_key) pairs expected for ``as_of``."""
    a = _date(as_of)
    return [
        ("1d", F.date_format(F.date_sub(a, 1), "yyyy-MM-dd")),
        ("this_week", iso_week_key(a)),
        ("month", cycle_of(a)),
        ("last_month", cycle_of(F.add_months(a, -1))),
        ("quarter", quarter_key(a)),
        ("this_year", year_key(a)),
        ("last_year", year_key(F.add_months(a, -12))),
        ("last_quarter", quarter_key(F.add_months(a, -3))),
    ]


def period_keys_array(as_of) -> Column:
    """PRJ11/SET1: the pairs as one ``array<struct>`` literal, for ``inline``."""
    return F.array(
        *[F.struct(F.lit(t).alias("report_type"), k.alias("period_key")) for t, k in period_keys_for(as_of)]
    )


def day_periods(date_col: Column | str) -> Column:
    """Periods a booking date belongs to, for the day-based report types."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.array(
        F.struct(F.lit("1d").alias("report_type"), F.date_format(d, "yyyy-MM-dd").alias("period_key")),
        F.struct(F.lit("this_week").alias("report_type"), iso_week_key(d).alias("period_key")),
    )


def cycle_periods(cycle_col: Column | str) -> Column:
    """Periods a billing cycle belongs to, for the month-based report types."""
    c = F.col(cycle_col) if isinstance(cycle_col, str) else cycle_col
    first = cycle_start(c)
    return F.array(
        F.struct(F.lit("month").alias("report_type"), c.alias("period_key")),
        F.struct(F.lit("quarter").alias("report_type"), quarter_key(first).alias("period_key")),
        F.struct(F.lit("this_year").alias("report_type"), year_key(first).alias("period_key")),
    )
