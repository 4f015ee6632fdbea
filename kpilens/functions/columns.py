"""Column-level helpers: month bounds, safe ratios, the lift rule, rounding."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpilens.config import RATIO_DIGITS


def col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def month_bounds(month: str) -> tuple[str, str]:
    """Half-open [first of month, first of next month) as timestamp literals."""
    y, m = int(month[:4]), int(month[5:7])
    start = date(y, m, 1)
    end = date(y + (m == 12), m % 12 + 1, 1)
    return f"{start.isoformat()} 00:00:00", f"{end.isoformat()} 00:00:00"


def _merge_months(months: list[str]) -> list[tuple[str, str]]:
    ranges: list[list[str]] = []
    for m in sorted(set(months)):
        a, b = month_bounds(m)
        if ranges and ranges[-1][1] == a:
            ranges[-1][1] = b
        else:
            ranges.append([a, b])
    return [(a, b) for a, b in ranges]


def month_range(ts: Column | str, months: list[str] | str) -> Column:
    """Sargable month filter: an OR of half-open ranges (adjacent months merged), so the
    parquet scan receives `ts >= a AND ts < b` instead of a non-pushable date_format test."""
    months = [months] if isinstance(months, str) else list(months)
    c = col(ts)
    cond = None
    for a, b in _merge_months(months):
        part = (c >= F.lit(a).cast("timestamp_ntz")) & (c < F.lit(b).cast("timestamp_ntz"))
        cond = part if cond is None else (cond | part)
    return cond if cond is not None else F.lit(False)


def before(ts: Column | str, day: str) -> Column:
    return col(ts) < F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as DOUBLE, NULL when b is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def money(c: Column | str) -> Column:
    """Decimal sums are exact; they are reported as DOUBLE."""
    return col(c).cast("double")


PART = 1_000_000_000


def exact_parts(c: Column | str) -> tuple[Column, Column]:
    """An amount of two decimals as whole cents in two parts of at most ten digits. Their sums are plain long sums, which
    cannot overflow below four thousand million rows whatever the amounts; a sum of DECIMAL(18, 2) works on objects."""
    cents = (col(c) * F.lit(100)).cast("long")
    high = F.call_function("div", cents, F.lit(PART))
    return high, cents - high * F.lit(PART)


def exact_total(high: Column | str, low: Column | str) -> Column:
    """The DECIMAL(38, 2) sum of amounts from the sums of their parts."""
    whole = col(high).cast("decimal(20,0)") * F.lit(Decimal(PART) / 100)
    return (whole + col(low).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def lift_parts(share_of_change: Column, share_of_base: Column) -> tuple[Column, Column]:
    """SURVEY 7.4 item 1: a brand-new segment (base share 0, change share > 0) has an
    infinite lift and passes the lift test; 0/0 is undefined and never passes.
    Returns (lift or NULL, is_new_segment)."""
    lift = F.when(share_of_base != 0, share_of_change / share_of_base)
    is_new = (share_of_base == 0) & (share_of_change != 0)
    return lift, F.coalesce(is_new, F.lit(False))


def fact_months(months: list[str] | str) -> Column:
    """Period filter on the fact: the order-time range (pushed into the orders parquet scan
    when the fact is built from the source tables) AND the month key (prunes partitions
    when the fact is read from its month-partitioned materialisation). Both say the same."""
    ms = [months] if isinstance(months, str) else list(months)
    return month_range("order_created_at", ms) & F.col("month").isin(*ms)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, on the wall clock: no session time
    zone enters (casting to TIMESTAMP would, and would shorten gaps across a DST change)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(ts))
