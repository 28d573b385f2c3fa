"""The classifier learns a planted rule; probabilities are probabilities."""

from pyspark.sql import functions as F

from delivery_lake.operators import enrich, ml
from delivery_lake.plans import gold


def test_forest_learns_planted_rule(spark, sf_small):
    data = enrich.ml_dataset(gold.wide_orders(spark, sf_small)) \
        .withColumn("late_delivery", F.col("estimated_delivery_days") <= 20)
    split = ml.stratified_split(ml.coerce_target(data)).cache()
    model = ml.fit(split.where(~F.col("is_test")), "forest")
    pred = ml.predict(model, split.where(F.col("is_test"))).cache()
    rep = {r.class_label: r for r in ml.classification_report(pred).collect()}
    base_rate = split.agg(F.avg("label")).first()[0]
    assert rep["1"].recall > base_rate
    assert rep["accuracy"].f1_score > 0.9
    lo, hi = pred.agg(F.min("late_probability"), F.max("late_probability")).first()
    assert 0.0 <= lo <= hi <= 1.0
    cm = {r.true_label: (r.predicted_0, r.predicted_1) for r in ml.confusion_matrix(pred).collect()}
    assert sum(a + b for a, b in cm.values()) == pred.count()
    split.unpersist()
    pred.unpersist()


def test_unseen_category_encodes_as_zeros_and_null_as_mode(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from delivery_lake.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

    cols = ", ".join([f"{c} double" for c in NUMERIC_FEATURES] + [f"{c} string" for c in CATEGORICAL_FEATURES])
    row = lambda state, label: tuple([1.0] * len(NUMERIC_FEATURES)) + (state, "S", "cat", "boleto", label)
    train = spark.createDataFrame([row("A", 1.0), row("A", 0.0), row("B", 0.0), row("B", 1.0), row("A", 0.0)],
                                  cols + ", label double").withColumn("class_weight", F.lit(1.0))
    model = ml.build_pipeline(train, "logistic").fit(train)
    prep = PipelineModel(stages=model.stages[:-1])
    test = spark.createDataFrame([row("A", 0.0), row("Z", 0.0), row(None, 0.0)], cols + ", label double")
    got = [r[0] for r in prep.transform(test).select(vector_to_array("customer_state__ohe")).collect()]
    assert got[0] == [1.0, 0.0]          # "A" is the most frequent value
    assert got[1] == [0.0, 0.0]          # unseen value: all zeros
    assert got[2] == got[0]              # missing value: filled with the most frequent value


def test_models_predict_after_an_observation(spark, sf_small):
    """Losses are observed in the pipeline's session before it trains: the models must still reach the tasks."""
    from pyspark.sql import Observation

    seen = Observation("any")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 5
    data = ml.coerce_target(enrich.ml_dataset(gold.wide_orders(spark, sf_small))).cache()
    for kind in ("forest", "logistic"):
        model = ml.fit(data, kind)
        assert not model.stages[-1].hasSummary and ml.predict(model, data).count() == data.count()
        assert ml.predict(model, data).where("late_probability between 0 and 1").count() == data.count()
    data.unpersist()


def test_forest_keeps_no_second_copy_of_its_rows(spark, sf_small, monkeypatch):
    """Node ids and the weighted rows are not cached beside the forest's bagged rows."""
    data = ml.coerce_target(enrich.ml_dataset(gold.wide_orders(spark, sf_small))).cache()
    seen, build = [], ml.build_pipeline

    def watched(train, model):
        seen.append(train.is_cached)
        return build(train, model)

    monkeypatch.setattr(ml, "build_pipeline", watched)
    forest = ml.fit(data).stages[-1]
    assert seen == [False] and not forest.getOrDefault("cacheNodeIds")
    assert len(forest.trees) == 100
    data.unpersist()
