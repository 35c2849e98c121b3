"""Prepared daily metrics shared by the reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.core import by_day
from daypanel.functions import scalars as sc
from daypanel.functions.stats import rolling_slope


@dataclass(frozen=True)
class Goals:
    """Report parameters of one run (fixed defaults)."""

    height_cm: float = 175.0
    target_weight: float = 70.0
    target_energy: float = 2000.0
    protein_goal: float = 100.0
    fiber_goal: float = 25.0
    tolerance: float = 0.1


def prepare_metrics(daily: DataFrame, goals: Goals = Goals()) -> DataFrame:
    """Body-mass index, 7-row velocity, macro shares, deficit, on-track flag, calendar fields."""
    energy, weight = F.col("energy"), F.col("weight")
    daily = daily.withColumn("_rn", F.row_number().over(by_day()))
    return daily.withColumns(
        {
            "bmi": sc.bmi(weight, goals.height_cm),
            "weight_velocity_7d": rolling_slope(weight, F.col("_rn"), 7) * 7,
            "protein_pct": sc.macro_share(F.col("protein"), "protein", energy),
            "carbs_pct": sc.macro_share(F.col("carbs"), "carbs", energy),
            "fat_pct": sc.macro_share(F.col("fat"), "fat", energy),
            "deficit": F.lit(goals.target_energy) - energy,
            "on_track": sc.within_tolerance(energy, goals.target_energy, goals.tolerance),
            "protein_per_kg": sc.ratio(F.col("protein"), weight),
            "month": F.month("day"),
            "weekday": F.weekday("day"),
            "is_weekend": sc.is_weekend(F.col("day")),
        }
    ).drop("_rn")
