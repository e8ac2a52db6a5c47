"""Row predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

# Required fields, gone status, error level, catalog bucket, horizon, reachable rows per filter.
REQUIRED_FIELDS = ("make", "model", "sales_price_incl_vat", "currency")
GONE_STATUS = 410
ERROR_LEVEL = 40
OTHERS_BUCKET = "Sonstige"
ALERT_HORIZON = "1 minute"
CAP_S = 400
CAP_U = 2000


def is_valid(*cols: Column) -> Column:
    return reduce(and_, [c.isNotNull() for c in cols])


def has_price(c: Column) -> Column:
    return c.isNotNull()


def has_currency(c: Column) -> Column:
    return c.isNotNull()


def not_other(c: Column, token: str = OTHERS_BUCKET) -> Column:
    return ~c.contains(token)


def is_gone(status: Column) -> Column:
    return F.coalesce(status == GONE_STATUS, F.lit(False))


def in_state(c: Column, state: str) -> Column:
    return c == state


def has_errors(count: Column) -> Column:
    return F.coalesce(count, F.lit(0)) != 0


def is_error(level: Column, code: int | str = ERROR_LEVEL) -> Column:
    return level == code


def is_recent(ts: Column, now: str | Column, horizon: str = ALERT_HORIZON) -> Column:
    """`ts + horizon >= now`, written as a bound on `ts` so that the scan can use it."""
    now = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    return ts >= now - F.expr(f"interval {horizon}")


def over_cap(n: Column, cap: int) -> Column:
    return n > cap
