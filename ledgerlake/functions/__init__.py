"""Column-level helpers built only from ``pyspark.sql.functions``."""

from .breakdown import (
    breakdown_array,
    breakdown_sum,
    conform_breakdown,
    flatten_breakdown,
)
from .cycles import (
    REPORT_TYPES,
    cycle_of,
    cycle_periods,
    cycle_range,
    day_periods,
    in_month,
    iso_week_key,
    last_cycles,
    last_days,
    month_end,
    normalize_cycle,
    period_keys_array,
    period_keys_for,
    prior_cycles_booked,
    quarter_key,
    stored_in_month,
    stored_last_days,
    valid_cycle,
    year_key,
)
from .keys import dedup_key, empty_account, env_tag, legacy_account
from .money import RECONCILE_TOLERANCE, as_sum, money, payment_amount, ratio, within_tolerance

__all__ = [n for n in dir() if not n.startswith("_")]
