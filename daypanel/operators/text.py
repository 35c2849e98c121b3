"""Text labelling: exact stratified sample, preview, text preparation, classifier."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default category, label names and their numbers.
DEFAULT_CATEGORY = "Miscellaneous"
LABELS = {"Not Junk": 0, "Junk": 1}
BUCKETS = 65536


def fill_category(foods: DataFrame, column: str = "category") -> DataFrame:
    return foods.fillna({column: DEFAULT_CATEGORY})


def order_hash(key: Column, seed: int) -> Column:
    """Repeatable pseudo-random order of rows."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def hash_bucket(h: Column) -> Column:
    """The first four hex digits: 65536 buckets in hash order."""
    return F.conv(F.substring(h, 1, 4), 16, 10).cast("int")


def first_by_bucket(
    rows: DataFrame, group: list[str], bucket: str, order: list[Column], quota: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The first rows of every group in ``order`` up to its quota; ``bucket`` is a coarse order.

    ``quota`` adds a ``_quota`` column to the small table of counts per group and bucket.  Counts
    show which buckets lie inside the quota or cross it; rows of the others never leave the
    join.  Ranks are taken within one bucket, so a group holding any share of all rows is
    spread over its buckets and never sorted in one task.
    """
    counts = quota(rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_c")))
    upto = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
    counts = counts.filter(F.col("_before") < F.col("_quota")).select(
        *group, bucket, "_before", "_quota", (F.col("_before") + F.col("_c") <= F.col("_quota")).alias("_inside")
    )
    spec = Window.partitionBy(*group, bucket).orderBy(*order)
    kept = rows.join(counts, [*group, bucket]).withColumn("_k", F.row_number().over(spec))
    kept = kept.filter(F.col("_inside") | (F.col("_k") <= F.col("_quota") - F.col("_before")))
    return kept.drop("_before", "_quota", "_inside", "_k")


def stratum_quotas(counts: DataFrame, stratum: str, size: int) -> DataFrame:
    """(stratum, quota) from (stratum, n): shares by largest remainder, ties by stratum.

    Whole-number arithmetic keeps the remainders exact; the two totals are scalar subqueries.
    """
    if size <= 0:
        raise ValueError("size must be positive")
    shares = counts.withColumn("_total", counts.agg(F.sum("n")).scalar())
    shares = shares.withColumns(
        {"_floor": F.expr(f"n * {size}L div _total"), "_rest": (F.col("n") * size) % F.col("_total")}
    )
    left = shares.agg(F.lit(size) - F.sum("_floor")).scalar()
    ranked = shares.withColumns(
        {
            "_all": F.lit(1),
            "_bucket": (BUCKETS - 1 - F.floor(F.col("_rest") * BUCKETS / F.col("_total"))).cast("int"),
        }
    )
    extra = first_by_bucket(
        ranked, ["_all"], "_bucket", [F.col("_rest").desc(), F.col(stratum)], lambda c: c.withColumn("_quota", left)
    ).select(F.col(stratum).alias("_x"), F.lit(1).alias("_extra"))
    quota = F.least(F.col("n"), F.col("_floor") + F.coalesce("_extra", F.lit(0)))
    return shares.join(extra, F.col(stratum).eqNullSafe(F.col("_x")), "left").select(stratum, quota.alias("_quota"))


def stratified_sample(rows: DataFrame, stratum: str, key: str, size: int = 2000, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (all if fewer), proportional by stratum, repeatable by seed.

    Rows without a stratum are left out; fill the column first.
    """
    rows = rows.filter(F.col(stratum).isNotNull())
    hashed = rows.withColumn("_h", order_hash(F.col(key), seed)).withColumn("_b", hash_bucket(F.col("_h")))

    def quota(counts: DataFrame) -> DataFrame:
        # The same counts again, so that their one exchange serves both.
        strata = counts.groupBy(stratum).agg(F.sum("_c").alias("n"))
        return counts.join(stratum_quotas(strata, stratum, size), stratum)

    picked = first_by_bucket(hashed, [stratum], "_b", [F.col("_h"), F.col(key)], quota)
    return picked.drop("_h", "_b")


def preview(rows: DataFrame, key: str, n: int = 5, seed: int = 42) -> DataFrame:
    """A repeatable random handful of rows."""
    return rows.orderBy(order_hash(F.col(key), seed), key).limit(n)


def label_number(label: Column) -> Column:
    out = F.lit(None).cast("int")
    for text, number in LABELS.items():
        out = F.when(label == text, number).otherwise(out)
    return out


def label_text(number: Column) -> Column:
    out = F.lit(None).cast("string")
    for text, value in LABELS.items():
        out = F.when(number == value, text).otherwise(out)
    return out


def model_text(name: Column, category: Column, missing_as_blank: bool = False) -> Column:
    """Lower-case ``name - category``; a missing part gives null, or blank when scoring."""
    if missing_as_blank:
        name, category = F.coalesce(name, F.lit("")), F.coalesce(category, F.lit(""))
    return F.concat(F.lower(name), F.lit(" - "), F.lower(category))


def prepare_text(foods: DataFrame, scoring: bool = False) -> DataFrame:
    out = foods.withColumns(
        {
            "food_name": F.lower("food_name"),
            "category": F.lower("category"),
            "combined": model_text(F.col("food_name"), F.col("category"), scoring),
        }
    )
    return out if scoring or "label" not in foods.columns else out.withColumn("label", label_number(F.col("label")))


def train_classifier(
    labelled: DataFrame, text: str = "combined", label: str = "label", features: int = 1 << 16, iterations: int = 10
) -> PipelineModel:
    """Hashed token frequencies with a logistic model, over whole texts; training is distributed."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\W+"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=iterations, regParam=0.01),
    ]
    usable = labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    return Pipeline(stages=stages).fit(usable.withColumn(label, F.col(label).cast("double")))


def label_table(model: PipelineModel, rows: DataFrame, text: str = "combined") -> DataFrame:
    """Add ``generated_label`` and ``score``; a missing text is scored as blank."""
    ready = rows.withColumn(text, F.coalesce(text, F.lit("")))
    scored = model.transform(ready)
    return scored.select(
        *rows.columns, vector_to_array("probability")[1].alias("score"),
        label_text(F.col("prediction").cast("int")).alias("generated_label"),
    )
