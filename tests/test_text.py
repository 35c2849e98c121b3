import hashlib

from pyspark.sql import functions as F

from daypanel.operators import text


def test_sample_is_exact_proportional_and_repeatable(spark):
    # One stratum holds most of the rows.
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "warm").otherwise("cold").alias("s"))
    got = text.stratified_sample(rows, "s", "id", 333)
    sizes = {r["s"]: r["count"] for r in got.groupBy("s").count().collect()}
    assert sum(sizes.values()) == 333 and sizes["hot"] == 233 and sizes["warm"] == 67 and sizes["cold"] == 33
    rank = lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest()
    want = sorted((i for i in range(5000) if i % 10 == 9), key=rank)[:33]
    assert sorted(r["id"] for r in got.filter("s = 'cold'").collect()) == sorted(want)
    assert text.stratified_sample(rows, "s", "id", 9000).count() == 5000


def test_quota_remainders(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "s string, n long")
    got = {r["s"]: r["_quota"] for r in text.stratum_quotas(counts, "s", 4).collect()}
    # 12/7, 12/7, 4/7: floors 1, 1, 0; the two largest remainders are those of a and b.
    assert got == {"a": 2, "b": 2, "c": 0}


def test_labels_and_model_text(spark):
    foods = spark.createDataFrame([("Apple", "Fruit", "Not Junk"), ("Cola", None, "Junk"), ("X", "Y", "?")], "food_name string, category string, label string")
    rows = text.prepare_text(foods).collect()
    assert [(r["combined"], r["label"]) for r in rows] == [("apple - fruit", 0), (None, 1), ("x - y", None)]
    scoring = text.prepare_text(foods.drop("label"), scoring=True).collect()
    assert scoring[1]["combined"] == "cola - "
    assert text.fill_category(foods).filter("category = 'Miscellaneous'").count() == 1


def test_classifier_learns_a_word(spark):
    rows = [(f"crispy fried snack {i}", "snacks", "Junk") for i in range(20)] + [(f"fresh green leaf {i}", "vegetables", "Not Junk") for i in range(20)]
    foods = text.prepare_text(spark.createDataFrame(rows, "food_name string, category string, label string"))
    model = text.train_classifier(foods)
    unseen = text.prepare_text(spark.createDataFrame([("fried thing", "snacks"), ("green thing", None)], "food_name string, category string"), scoring=True)
    got = [r["generated_label"] for r in text.label_table(model, unseen).collect()]
    assert got == ["Junk", "Not Junk"]
