"""API usage: tumbling rate windows, allowances and usage summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Requests a minute by tier.
LIMITS: dict[str, int] = {"anonymous": 10, "free": 60, "research": 300, "institutional": 1000}


def caller(key_prefix: Column, forwarded: Column) -> Column:
    """``key:`` and the prefix, else ``ip:`` and the first forwarded address."""
    return F.when(key_prefix.isNotNull(), F.concat(F.lit("key:"), key_prefix)).otherwise(
        F.concat(F.lit("ip:"), F.trim(F.element_at(F.split(forwarded, ","), 1)))
    )


def limit_of(tier: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in LIMITS.items() for x in kv])[tier], F.lit(LIMITS["anonymous"]))


def rate_windows(events: DataFrame) -> DataFrame:
    """(caller, window_start, count) by minute; also the streaming form's aggregate."""
    return events.groupBy("caller", F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("count")).select(
        "caller", F.col("w.start").alias("window_start"), "count"
    )


def decisions(events: DataFrame, id_col: str = "event_id") -> DataFrame:
    """Every request with its count on arrival, allowed, remaining and reset.

    ``events``: caller, tier, ts, id.  The key includes the minute, so a busy caller is
    spread over its minutes.
    """
    minute = F.date_trunc("minute", "ts")
    marked = events.withColumn("window_start", minute)
    order = Window.partitionBy("caller", "window_start").orderBy("ts", id_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.count("*").over(order)
    cap = limit_of(F.col("tier"))
    return marked.withColumn("count", n).withColumns(
        {"allowed": F.col("count") <= cap, "remaining": F.greatest(cap - F.col("count"), F.lit(0)), "reset_at": F.col("window_start") + F.expr("INTERVAL 1 MINUTE")}
    )


def expire(windows: DataFrame, now: datetime, hours: int = 1) -> DataFrame:
    """Windows not older than the bound."""
    return windows.where(F.col("window_start") >= F.lit(now) - F.make_interval(hours=F.lit(hours)))


def daily(events: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """Requests by day over the last days."""
    since = F.lit(now) - F.make_interval(days=F.lit(days))
    return events.where((F.col("ts") >= since) & (F.col("ts") <= F.lit(now))).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


def today_and_month(events: DataFrame, now: datetime) -> DataFrame:
    """Requests of a caller today and this month, up to now."""
    seen = events.where(F.col("ts") <= F.lit(now))
    return seen.groupBy("caller").agg(
        F.count_if(F.col("ts") >= F.date_trunc("day", F.lit(now))).alias("today"),
        F.count_if(F.col("ts") >= F.date_trunc("month", F.lit(now))).alias("month"),
    )


def key_owners(keys: DataFrame, users: DataFrame) -> DataFrame:
    """Keys in force with their owners."""
    return keys.where("revoked_at IS NULL").join(users, "user_id")


def usable_tokens(tokens: DataFrame, now: datetime) -> DataFrame:
    return tokens.where(F.col("used_at").isNull() & (F.col("expires_at") > F.lit(now)))


def consumed(tokens: DataFrame, requests: DataFrame, now: datetime) -> DataFrame:
    """(request_id, token_id, granted): each usable token serves the first request for it alone.

    ``tokens``: token_id, used_at, expires_at.  ``requests``: request_id, token_id, at.  The
    caller marks the granted tokens as used in the same write (``upserts.advance``).
    """
    usable = usable_tokens(tokens, now).select("token_id").distinct().withColumn("__u", F.lit(True))
    turn = F.row_number().over(Window.partitionBy("token_id").orderBy("at", "request_id"))
    asked = requests.withColumn("__turn", turn).join(usable, "token_id", "left")
    return asked.select("request_id", "token_id", (F.coalesce("__u", F.lit(False)) & (F.col("__turn") == 1)).alias("granted"))
