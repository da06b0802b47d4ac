"""What is due, and which cached rows are fetched again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sampled


def as_bool(text: Column, default: bool) -> Column:
    low = F.lower(F.trim(text))
    return F.when(low.isin("1", "true", "yes", "on"), True).when(low.isin("0", "false", "no", "off"), False).otherwise(default)


def positive(text: Column, default: int) -> Column:
    n = F.trim(text).try_cast("int")
    return F.when(n > 0, n).otherwise(default)


def due(enabled: Column, interval: Column, last: Column, today: Column) -> Column:
    """Enabled, and never run or long enough ago; a last run in the future is not due."""
    days = F.datediff(today, last)
    return enabled & (last.isNull() | ((days >= 0) & (days >= interval)))


def decisions(registry: DataFrame, state: DataFrame, today: str) -> DataFrame:
    """registry (source, page, enabled, interval_days) and state (source, page, last_run): each page with due and reason."""
    d = registry.join(state, ["source", "page"], "left")
    day = F.lit(today).cast("date")
    on, every = as_bool(F.col("enabled"), True), positive(F.col("interval_days"), 1)
    reason = F.when(~on, "disabled").when(F.col("last_run").isNull(), "never_ran").when(F.datediff(day, "last_run") < 0, "in_future")
    reason = reason.when(F.datediff(day, "last_run") >= every, "interval_elapsed").otherwise("too_early")
    return d.withColumns({"due": due(on, every, F.col("last_run"), day), "reason": reason})


def needs_refresh(prior_seen: Column, today: Column, url: Column, stale_days: int = 30, percent: float = 5.0) -> Column:
    """No prior row, an unreadable date, a stale row, or one of the sample."""
    seen = F.try_to_date(prior_seen, "yyyy-MM-dd")
    return prior_seen.isNull() | seen.isNull() | (F.datediff(today, seen) >= stale_days) | sampled(url, percent)
