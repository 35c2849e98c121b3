"""Correlations of daily metrics with weight change: lags, p-values, intervals, best lag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, by_day, ensure_columns, numeric, rank_from_end
from daypanel.functions.stats import corr_p_value, fisher_bound, pair_count, safe_corr

# Wearable metrics of the lag report, label to column.
LAG_METRICS = {
    "steps": "w_steps",
    "distance": "w_distance_m",
    "active calories": "w_active_kcal",
    "resting HR": "w_resting_hr",
    "sleep duration": "w_sleep_seconds",
    "sleep score": "w_sleep_score",
    "avg stress": "w_avg_stress",
    "body battery min": "w_body_battery_min",
    "body battery max": "w_body_battery_max",
    "HRV": "w_hrv",
    "respiration": "w_respiration",
    "intensity minutes": "w_total_intensity_min",
}

# Nutrients whose correlation with weight is read as water retention.
WATER_NUTRIENTS = ["sodium", "carbs", "water"]


def wide_metrics(
    daily: DataFrame, metrics: Sequence[str] | Mapping[str, str], targets: Mapping[str, str]
) -> tuple[DataFrame, list[str]]:
    """(entity, day, targets, x) with all metrics of a day in the array x, and their labels; absent columns are null."""
    named = dict(metrics) if isinstance(metrics, Mapping) else {m: m for m in metrics}
    columns = [*named.values(), *targets.values()]
    daily = numeric(ensure_columns(daily, {c: "double" for c in named.values()}), columns)
    ys = [F.col(c).alias(y) for y, c in targets.items()]
    return daily.select(ENTITY, DAY, *ys, F.array(*(F.col(c).cast("double") for c in named.values())).alias("x")), list(named)


def lag_correlations(
    daily: DataFrame, metrics: Sequence[str] | Mapping[str, str], target: str = "weight_change",
    max_lag: int = 0, min_pairs: int = 3,
) -> DataFrame:
    """(entity, metric, lag, n, r) for every metric and lag; r is null below ``min_pairs``."""
    return lag_correlations_with(daily, metrics, {target: target}, max_lag, min_pairs).drop("target")


def lag_correlations_with(
    daily: DataFrame, metrics: Sequence[str] | Mapping[str, str], targets: Mapping[str, str],
    max_lag: int = 0, min_pairs: int = 3,
) -> DataFrame:
    """(target, entity, metric, lag, n, r) for several target series in one pass."""
    return lag_correlations_of(daily, metrics, targets, {"all": (None, min_pairs)}, max_lag).drop("part")


def lag_correlations_of(
    daily: DataFrame, metrics: Sequence[str] | Mapping[str, str], targets: Mapping[str, str],
    parts: Mapping[str, tuple[int | None, int]], max_lag: int = 0,
) -> DataFrame:
    """(part, target, entity, metric, lag, n, r) for several target series and several spans of rows in one pass.

    ``parts`` gives for each span how many of an entity's last rows it has (None: all) and how many pairs it needs.  A lag reaches back
    inside its span only, as if the rows before it were absent.

    One window by entity shifts the array of all metrics, so it shares the panel's partitioning and sort.  Metrics become rows
    only after it: the rows stay where they are, and the aggregate by (entity, metric) needs no exchange of its own.
    """
    names = {f"_y{i}": c for i, c in enumerate(targets.values())}
    rows, labels = wide_metrics(daily, metrics, names)
    lags = range(max_lag + 1)
    rows = rows.withColumns({f"_x{k}": F.lag("x", k).over(by_day()) if k else F.col("x") for k in lags} | {"_back": rank_from_end()})
    cell = [F.struct(F.lit(m).alias("metric"), *(F.col(f"_x{k}")[i].alias(f"_x{k}") for k in lags)) for i, m in enumerate(labels)]
    rows = rows.select(ENTITY, "_back", *names, F.inline(F.array(*cell)))
    aggs, cells = [], []
    for p, (part, (last, min_pairs)) in enumerate(parts.items()):
        for y, label in zip(names, targets):
            for k in lags:
                inside = F.lit(True) if last is None else F.col("_back") + k <= last
                x, n, r = F.when(inside, F.col(f"_x{k}")), f"_n{p}_{k}{y}", f"_r{p}_{k}{y}"
                aggs += [pair_count(x, F.col(y)).alias(n), safe_corr(x, F.when(inside, F.col(y))).alias(r)]
                cells.append(
                    F.struct(
                        F.lit(part).alias("part"), F.lit(label).alias("target"), F.lit(k).alias("lag"), F.col(n).alias("n"),
                        F.when(F.col(n) >= min_pairs, F.col(r)).alias("r"),
                    )
                )
    wide = rows.groupBy(ENTITY, "metric").agg(*aggs)
    return wide.select(ENTITY, "metric", F.inline(F.array(*cells)))


def with_significance(corr: DataFrame, alpha: float = 0.05) -> DataFrame:
    corr = corr.withColumn("p", corr_p_value(F.col("r"), F.col("n")))
    return corr.withColumn("significant", F.coalesce(F.col("p") < alpha, F.lit(False)))


def nutrient_correlations(daily: DataFrame, nutrients: Sequence[str]) -> DataFrame:
    """Same-day r and p per nutrient; entries with two pairs or fewer are left out."""
    return with_significance(lag_correlations(daily, nutrients, min_pairs=3)).filter("n > 2").drop("lag")


def lagged_correlations(daily: DataFrame, nutrients: Sequence[str], max_lag: int = 3) -> DataFrame:
    return with_significance(lag_correlations(daily, nutrients, max_lag=max_lag, min_pairs=11))


def correlation_intervals(daily: DataFrame, nutrients: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Same-day r with p and Fisher interval; needs more than ten pairs."""
    corr = with_significance(lag_correlations(daily, nutrients, min_pairs=11)).filter("n > 10").drop("lag")
    return with_interval(corr, confidence)


def with_interval(corr: DataFrame, confidence: float = 0.95) -> DataFrame:
    r, n = F.col("r"), F.col("n")
    return corr.withColumns(
        {"ci_low": fisher_bound(r, n, confidence, False), "ci_high": fisher_bound(r, n, confidence, True)}
    )


def size(r: Column) -> Column:
    """Absolute r to twelve digits, so that equal values differing in rounding noise are ties."""
    return F.round(F.abs(r), 12)


def best_lags(corr: DataFrame) -> DataFrame:
    """Per (entity, metric) the lag of largest absolute r, ties to the smallest lag."""
    usable = F.col("r").isNotNull()
    pick = F.max_by(
        F.struct("lag", "r", "n"),
        F.when(usable, F.struct(size(F.col("r")).alias("size"), (-F.col("lag")).alias("first"))),
    )
    best = corr.groupBy(ENTITY, "metric").agg(pick.alias("b"), F.bool_or(usable).alias("any"))
    best = best.withColumn("b", F.when(F.col("any"), F.col("b")))
    sign = F.when(F.col("b.r") >= 0, "positive").when(F.col("b.r") < 0, "negative").otherwise("na")
    return best.select(
        ENTITY, "metric", F.col("b.lag").alias("best_lag"), F.col("b.r").alias("best_r"),
        sign.alias("sign"), F.coalesce(F.col("b.n"), F.lit(0)).alias("sample_size"),
    )


def best_lags_of(corr: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Per (entity, metric) the best lag and its r of every part, as columns, in one aggregate."""
    picks = []
    for p in parts:
        usable = F.col("r").isNotNull() & (F.col("part") == p)
        picks.append(F.max_by(F.struct("lag", "r"), F.when(usable, F.struct(size(F.col("r")).alias("size"), (-F.col("lag")).alias("first")))).alias(f"_{p}"))
        picks.append(F.bool_or(usable).alias(f"_any_{p}"))
    best = corr.groupBy(ENTITY, "metric").agg(*picks)
    of = lambda p, c: F.when(F.col(f"_any_{p}"), F.col(f"_{p}.{c}")).alias(f"{p}_{'lag' if c == 'lag' else 'r'}")
    return best.select(ENTITY, "metric", *(of(p, c) for p in parts for c in ("lag", "r")))


def lag_matrix(corr: DataFrame, max_lag: int = 7) -> DataFrame:
    """(entity, metric) by lag, columns ``lag_0`` and up."""
    cells = [F.max(F.when(F.col("lag") == k, F.col("r"))).alias(f"lag_{k}") for k in range(max_lag + 1)]
    return corr.groupBy(ENTITY, "metric").agg(*cells)


def best_lag_bars(daily: DataFrame, nutrients: Sequence[str], max_lag: int = 3, confidence: float = 0.95) -> DataFrame:
    """Per nutrient the strongest lag, its interval, and the same-day interval beside it.

    A later lag replaces the same-day value only if its absolute r is strictly larger.
    """
    corr = with_interval(with_significance(lag_correlations(daily, nutrients, max_lag=max_lag, min_pairs=11)))
    usable = F.col("r").isNotNull()
    shown = F.max_by(
        F.struct("lag", "r", "n", "p", "significant", "ci_low", "ci_high"),
        F.when(usable, F.struct(size(F.col("r")).alias("size"), (-F.col("lag")).alias("first"))),
    )
    same = F.max(F.when(F.col("lag") == 0, F.struct("r", "n", "p", "significant", "ci_low", "ci_high")))
    out = corr.groupBy(ENTITY, "metric").agg(shown.alias("b"), same.alias("s"))
    return out.filter(F.col("s.n") > 10).select(
        ENTITY, "metric", F.col("s.r").alias("r_lag0"), F.col("s.p").alias("p_lag0"),
        F.col("s.significant").alias("significant_lag0"), F.col("s.n").alias("n_lag0"),
        F.col("s.ci_low").alias("ci_low_lag0"), F.col("s.ci_high").alias("ci_high_lag0"),
        F.col("b.lag").alias("best_lag"), F.col("b.r").alias("best_r"),
        F.col("b.ci_low").alias("ci_low"), F.col("b.ci_high").alias("ci_high"),
    )


def strongest_driver(bars: DataFrame) -> DataFrame:
    """Per entity the nutrient of largest same-day absolute r, with its best lag."""
    ranked = bars.filter("r_lag0 is not null")
    spec = Window.partitionBy(ENTITY).orderBy(size(F.col("r_lag0")).desc(), "metric")
    top = ranked.withColumn("_k", F.row_number().over(spec)).filter("_k = 1")
    return top.select(
        ENTITY, F.col("metric").alias("nutrient"), F.col("r_lag0").alias("r"), F.col("p_lag0").alias("p"),
        F.col("significant_lag0").alias("significant"), "best_lag", "best_r",
        F.when(F.col("r_lag0") > 0, "positively").otherwise("negatively").alias("direction"),
        F.when(F.col("metric").isin(WATER_NUTRIENTS), "water retention").otherwise("energy balance").alias("mechanism"),
    )


def strongest_driver_text(top: DataFrame) -> DataFrame:
    """One sentence per entity; presentation, last step."""
    sig = F.when(F.col("significant"), F.format_string("p=%.3f", "p")).otherwise("not statistically significant")
    lag = F.when(F.col("best_lag") > 0, F.format_string("strongest at a lag of %d days", "best_lag")).otherwise(
        "strongest on the same day"
    )
    text = F.format_string(
        "%s is %s correlated with weight change (r=%.3f, %s), %s; reads as %s",
        F.col("nutrient"), F.col("direction"), F.col("r"), sig, lag, F.col("mechanism"),
    )
    return top.withColumn("sentence", text)
