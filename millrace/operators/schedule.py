"""When brands are due, in which order, and how work is dealt to jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import backoff_hours


def weekday_slots(brands: DataFrame) -> DataFrame:
    """marka, slot: rank by name, modulo 7. Brands are some tens of rows."""
    return brands.select("marka", ((F.row_number().over(Window.orderBy("marka")) - 1) % 7).alias("slot"))


def due(last_good: Column, last_try: Column, last_state: Column, failures: Column, period_hours: Column, slot: Column, priority: Column, now: Column) -> Column:
    """(due, why) of a brand."""
    hours = lambda t: (F.unix_timestamp(now) - F.unix_timestamp(t)) / 3600
    said = lambda yes, why: F.struct(F.lit(yes).alias("due"), F.lit(why).alias("why"))
    bad = last_state.isin("hatali", "kismi", "karantina")
    return (
        F.when(last_good.isNull(), said(True, "never scanned well"))
        .when(bad & last_try.isNotNull() & (hours(last_try) < backoff_hours(failures)), said(False, "waits after a bad scan"))
        .when(bad, said(True, "again after a bad scan"))
        .when(hours(last_good) < period_hours, said(False, "within its period"))
        .when((period_hours >= 168) & (priority != 1) & (F.weekday(now) != slot), said(False, "on another weekday"))
        .otherwise(said(True, "period is over"))
    )


def plan(brands: DataFrame, start: Column, between_seconds: float = 180.0) -> DataFrame:
    """brands (marka, pages, pause, priority) with minutes and start: one after the other by priority, then name."""
    minutes = F.round(F.col("pages") * (F.col("pause") + 2.0) / 60, 1)
    w = Window.orderBy("priority", "marka").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("minutes") * 60 + between_seconds).over(w), F.lit(0.0))
    return brands.withColumn("minutes", minutes).withColumn("start", F.timestamp_seconds(F.unix_timestamp(start) + before))


def deal(brands: DataFrame, jobs: int) -> DataFrame:
    """marka, minutes, job: longest first, each to the job with the least so far. Some tens of rows in one group."""

    def dealt(rows):
        load = [0.0] * jobs
        out = []
        for r in rows.sort_values(["minutes", "marka"], ascending=[False, True]).itertuples():
            k = load.index(min(load))
            load[k] += r.minutes
            out.append((r.marka, r.minutes, k))
        return type(rows)(out, columns=["marka", "minutes", "job"])

    return brands.select("marka", F.col("minutes").cast("double").alias("minutes"), F.lit(0).alias("_one")).groupBy("_one").applyInPandas(dealt, "marka string, minutes double, job int")
