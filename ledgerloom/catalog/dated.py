"""Queries over dates and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.tables import sql_text, table, text_of, utc
from ledgerloom.functions.dates import epoch_millis, is_fresh, iso_utc, normalize_date
from ledgerloom.operators.ingest import freshness_reason

NOW = "2024-02-01T12:00:00Z"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def latest_event(spark: SparkSession, sf: str):
    return events(spark, sf).select(F.max("ts")).scalar()


def raw_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a date text in one of sixteen forms."""
    form = F.col("event_id") % 16
    amount = (F.col("user_id") + 1).cast("string")
    unit = F.get(F.array(*[F.lit(u) for u in ("second", "minutes", "Hours", "day", "weeks", "month")]), (F.col("event_id") % 6).cast("int"))
    raw = (
        F.when(form == 0, F.concat(F.lit("Posted "), amount, F.lit(" "), unit, F.lit(" ago")))
        .when(form == 1, F.lit(" Yesterday "))
        .when(form == 2, F.date_format("ts", "d MMM yyyy HH:mm:ss 'GMT'"))
        .when(form == 3, F.concat(F.lit("Mon, "), F.date_format("ts", "dd MMM yyyy HH:mm:ss '+0530'")))
        .when(form == 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(form == 5, F.date_format("ts", "MMMM d, yyyy"))
        .when(form == 6, F.lit("soon"))
        .when(form == 7, F.lit("just now"))
        .when(form == 8, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(form == 10, F.date_format("ts", "MMM d, yyyy hh:mm a"))
        .when(form == 11, F.date_format("ts", "yyyy-MM-dd hh:mm:ss a"))
        .when(form == 12, F.date_format("ts", "EEE, dd MMM yy HH:mm:ss 'GMT'"))
        .when(form == 13, F.date_format("ts", "EEE MMM d HH:mm:ss yyyy"))
        .when(form == 14, F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
        .when(form == 15, F.concat(F.lit("000000000000"), amount, F.lit(" hours ago")))
        .otherwise(F.lit(""))
    )
    return events(spark, sf).withColumn("raw_date", raw)


def date_normalise(spark: SparkSession, sf: str) -> DataFrame:
    published = normalize_date(F.col("raw_date"), utc(NOW))
    return raw_dates(spark, sf).select(
        "event_id", text_of(published).alias("published"), is_fresh(published, utc(NOW)).alias("fresh")
    )


def freshness_window(spark: SparkSession, sf: str) -> DataFrame:
    now = latest_event(spark, sf)
    dated = events(spark, sf).withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    keep = freshness_reason(F.col("ts"), now, "keep")
    drop = freshness_reason(F.col("ts"), now, "drop")
    return dated.groupBy("event_type").agg(
        F.count_if(is_fresh(F.col("ts"), now)).alias("fresh"),
        F.count_if(keep.isNull()).alias("kept_with_dateless"),
        F.count_if(drop == "stale").alias("stale"),
        F.count_if(drop == "dateless").alias("dateless"),
    )


def epoch_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.when(F.col("event_type") == "signup", F.lit(0)).otherwise(F.unix_millis("ts"))
    back = epoch_millis(millis.cast("bigint"))
    return events(spark, sf).select("event_id", text_of(back).alias("at"), iso_utc(back).alias("iso"))


_NOW = "TIMESTAMP '2024-02-01 12:00:00'"
_AGO = """INTERVAL 1 SECOND * (user_id + 1) * [1, 60, 3600, 86400, 604800, 2592000][event_id % 6 + 1]"""
_PUBLISHED = f"""CASE event_id % 16 WHEN 0 THEN {_NOW} - {_AGO}
  WHEN 1 THEN {_NOW} - INTERVAL 1 DAY
  WHEN 2 THEN date_trunc('second', ts)
  WHEN 3 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
  WHEN 4 THEN ts
  WHEN 5 THEN date_trunc('day', ts)
  WHEN 7 THEN {_NOW}
  WHEN 8 THEN date_trunc('minute', ts) WHEN 10 THEN date_trunc('minute', ts)
  WHEN 11 THEN date_trunc('second', ts) WHEN 12 THEN date_trunc('second', ts) WHEN 13 THEN date_trunc('second', ts)
  WHEN 14 THEN date_trunc('second', ts) WHEN 15 THEN {_NOW} - INTERVAL 1 HOUR * (user_id + 1) END"""

QUERIES = {
    "date_normalise": date_normalise,
    "freshness_window": freshness_window,
    "epoch_millis": epoch_round_trip,
}

ORACLE = {
    "date_normalise": f"""SELECT event_id, {sql_text('p')} AS published,
        coalesce({_NOW} - p <= INTERVAL 24 HOUR, false) AS fresh
      FROM (SELECT event_id, CAST({_PUBLISHED} AS TIMESTAMP) AS p FROM events)""",
    "freshness_window": """SELECT event_type, count(*) FILTER (d >= now - INTERVAL 24 HOUR) AS fresh,
        count(*) FILTER (d IS NULL OR d >= now - INTERVAL 24 HOUR) AS kept_with_dateless,
        count(*) FILTER (d < now - INTERVAL 24 HOUR) AS stale, count(*) FILTER (d IS NULL) AS dateless
      FROM (SELECT event_type, CASE WHEN event_type <> 'error' THEN ts END AS d, (SELECT max(ts) FROM events) AS now FROM events)
      GROUP BY event_type""",
    "epoch_millis": f"""SELECT event_id, {sql_text('t')} AS at, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS iso
      FROM (SELECT event_id, CASE WHEN event_type <> 'signup' THEN date_trunc('millisecond', ts) END AS t FROM events)""",
}
