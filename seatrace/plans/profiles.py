"""Speed profile of each vessel (P7, G6), from positions or from daily moments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vessel_profiles(positions: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of speed; the latter is null for a single point."""
    return (
        positions.filter(F.col("mmsi").isNotNull() & F.col("speed").isNotNull())
        .groupBy("mmsi")
        .agg(F.avg("speed").alias("avg_speed"), F.stddev_samp("speed").alias("speed_std_dev"))
    )


def speed_moments(positions: DataFrame) -> DataFrame:
    """Count, mean and sum of squared deviations of speed per vessel and date.

    Days add up to a profile, so a daily job reads its own day only.
    """
    known = positions.filter(F.col("mmsi").isNotNull() & F.col("speed").isNotNull())
    return known.groupBy("mmsi", "date").agg(
        F.count("speed").alias("n"),
        F.avg("speed").alias("mean"),
        (F.var_pop("speed") * F.count("speed")).alias("squares"),
    )


def merged_profiles(moments: DataFrame) -> DataFrame:
    """``vessel_profiles`` from ``speed_moments``. Squares are taken about the vessel's own
    mean, as the difference of two large sums would lose digits."""
    means = moments.groupBy("mmsi").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_speed"))
    off = F.col("mean") - F.col("avg_speed")
    return (
        moments.join(means, "mmsi")
        .groupBy("mmsi", "avg_speed")
        .agg(F.sum("n").alias("n"), F.sum(F.col("squares") + F.col("n") * off * off).alias("squares"))
        .select(
            "mmsi",
            "avg_speed",
            F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("speed_std_dev"),
        )
    )
