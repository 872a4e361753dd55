"""Gold operators: business aggregates over silver tables, and time-cut reads of bronze.

Money and readings are summed as wide DECIMALs, so the result does not depend on
the order in which partial sums are combined across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SCALE = 12


def exact_sum(col: Column, scale: int | None = SCALE) -> Column:
    """Sum of a numeric column as a double, the same in whatever order partial sums meet.

    Values are added as DECIMAL(38, ``scale``). What a double has beyond ``scale`` digits after the point, and doubles too
    large for the decimal, are added apart as doubles, so nothing is rounded away. A NaN or an infinity makes the sum what
    floating-point addition makes it. With ``scale=None`` the values are added in their own type: exact for decimals and
    integers, and for doubles the plain floating-point sum.
    """
    if scale is None:
        return F.sum(col).cast("double")
    value = col.cast("double")
    fits = F.coalesce(col.try_cast(f"decimal(38,{scale})"), F.lit(0).cast(f"decimal(38,{scale})"))
    # 0 for values of up to ``scale`` digits after the point: their decimal is the same double.
    rest = F.when(F.abs(value) < float("inf"), value - fits.cast("double")).otherwise(value)
    return F.sum(F.when(col.isNotNull(), fits)).cast("double") + F.sum(rest)


def exact_mean(col: Column, scale: int | None = SCALE) -> Column:
    """Mean of a numeric column (nulls excluded) as a double, from ``exact_sum``; NaN if one of its values is."""
    return exact_sum(col, scale) / F.count(col)


def sales_by_channel_week(orders: DataFrame, channel: str, ts: str, amount: str, scale: int | None = SCALE) -> DataFrame:
    """Orders and sales per channel and ISO week (weeks start on Monday)."""
    return (orders.groupBy(F.col(channel).alias("channel"),
                           F.date_trunc("week", F.col(ts)).cast("date").alias("week"))
                  .agg(F.count(F.lit(1)).alias("orders"), exact_sum(F.col(amount), scale).alias("sales")))


def delivery_time_by_supplier(shipments: DataFrame, supplier: str, start_ts: str, end_ts: str,
                              unit: str = "days") -> DataFrame:
    """Mean time from start to end per supplier: whole calendar ``days`` (mean_days), or ``hours`` to the microsecond
    (mean_hours).

    Negative durations are data errors and count as unknown; unknown durations
    (in transit or wrong) are excluded from the mean and counted separately.
    """
    if unit == "days":
        span, size = F.datediff(F.col(end_ts), F.col(start_ts)), 1
    elif unit == "hours":
        def micros(c: str) -> Column:
            return F.unix_micros(F.col(c).cast("timestamp"))
        span, size = micros(end_ts) - micros(start_ts), 3_600_000_000
    else:
        raise ValueError(f"unit '{unit}' is not days or hours")
    return (shipments.withColumn("_span", F.when(span >= 0, span))
            .groupBy(F.col(supplier).alias("supplier"))
            .agg(F.count(F.lit(1)).alias("shipments"),
                 F.count("_span").alias("delivered"),
                 F.count_if(F.col("_span").isNull()).alias("unknown"),
                 (F.sum("_span").cast("double") / size / F.count("_span")).alias(f"mean_{unit}")))


def mean_by_group_day(readings: DataFrame, group: str, ts: str, value: str, scale: int | None = SCALE) -> DataFrame:
    """Mean, min, max and count of a reading per group and calendar day."""
    return (readings.groupBy(F.col(group).alias("grp"), F.to_date(F.col(ts)).alias("day"))
                    .agg(F.count(value).alias("readings"),
                         exact_mean(F.col(value), scale).alias("mean_value"),
                         F.min(value).alias("min_value"),
                         F.max(value).alias("max_value")))


def as_of(bronze: DataFrame, cut, ingested_at: str = "_ingested_at",
          ingested_date: str | None = "_ingested_date") -> DataFrame:
    """Bronze as it was at ``cut``: only rows ingested at or before it.

    When the table is partitioned by ingestion date, a bound on that column is
    added so later partitions are pruned rather than scanned. The bound is one
    day loose, so a writer in another time zone cannot make it drop rows.
    """
    cut_col = cut if isinstance(cut, Column) else F.lit(cut)
    out = bronze.where(F.col(ingested_at) <= cut_col)
    if ingested_date and ingested_date in bronze.columns:
        out = out.where(F.col(ingested_date) <= F.date_add(F.to_date(cut_col), 1))
    return out
