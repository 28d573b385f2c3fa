"""Late-delivery classifier as Spark ML jobs.

Training data is the Gold ML table (C15). Preprocessing mirrors the original: numeric
features median-imputed and standardised, categorical features filled with their most
frequent value and one-hot encoded (unknown values -> all zeros), balanced class weights,
then a random forest or a logistic regression. Every statistic is fitted on the training
part only. Evaluation is one small aggregation over (label, prediction).
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_lake.functions import bool_from_text
from delivery_lake.operators.infer import cast_inferred
from delivery_lake.schemas import (
    FOREST_PARAMS,
    LOGISTIC_MAX_ITER,
    LOGISTIC_TOL,
    ML_ID,
    ML_TARGET,
    SPLIT_SEED,
    TEST_SHARE,
)
from delivery_lake.sources.files import path_exists

LABEL = "label"
WEIGHT = "class_weight"
# Performance setting of the forest (no effect on the model): 1 GB of split statistics per pass. Node ids are not
# cached: they are 100 numbers a row and pass, kept for three passes, which is more than the rows themselves.
FOREST_TUNING = {"cacheNodeIds": False, "maxMemoryInMB": 1024}
# Split thresholds of a numeric feature come from this many bins, whose edges Spark's trees take from a
# sample of at most max(maxBins^2, 10,000) training rows: a documented parameter of the fit.
FOREST_BINS = 32
# 16-bit buckets of the split hash: the boundary bucket holds ~1/65536 of a class.
SPLIT_BUCKET_HEX = 4


# --- F01-F03 -------------------------------------------------------------------------------

def coerce_target(df: DataFrame, target: str = ML_TARGET) -> DataFrame:
    """target to a DOUBLE ``label`` (text/boolean -> 1.0/0.0); unknown targets dropped."""
    if target not in df.columns:
        raise ValueError(f"target column missing: {target}")
    t = F.col(target)
    flag = t if dict(df.dtypes)[target] == "boolean" else bool_from_text(t)
    return df.withColumn(LABEL, flag.cast("double")).where(F.col(LABEL).isNotNull())


# Columns that are never features: the id, the target and what training adds.
NO_FEATURES = {ML_ID, ML_TARGET, LABEL, WEIGHT, "is_test"}
_NUMERIC_TYPES = (T.IntegralType, T.FractionalType)
_CATEGORICAL_TYPES = (T.StringType, T.BooleanType)


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """numeric and categorical features by the types found: numbers, and texts and truth values, in
    the order of the columns. The id and the target are never features. A table read as text goes
    through ``infer.cast_inferred`` first."""
    kinds = [(f.name, f.dataType) for f in df.schema if f.name not in NO_FEATURES]
    return [c for c, t in kinds if isinstance(t, _NUMERIC_TYPES)], [c for c, t in kinds if isinstance(t, _CATEGORICAL_TYPES)]


def feature_table(df: DataFrame) -> DataFrame:
    """F02 as a table: ``feature, kind, position``. Text columns are typed by their values first."""
    num, cat = feature_columns(cast_inferred(df))
    rows = [(c, "numeric", i) for i, c in enumerate(num)] + [(c, "categorical", i) for i, c in enumerate(cat)]
    return df.sparkSession.createDataFrame(rows, "feature string, kind string, position int")


# --- F04 stratified split ----------------------------------------------------------------------

def split_hash(key: str = ML_ID, seed: int = SPLIT_SEED):
    """md5 hex of 'seed:key': uniform, stable under repartitioning, checkable in SQL."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, label: str = LABEL, test_share: float = TEST_SHARE,
                     seed: int = SPLIT_SEED, key: str = ML_ID) -> DataFrame:
    """adds ``is_test``; per class exactly floor(n_c * share + 0.5) rows are test rows,
    namely those with the smallest hash.

    No class-wide sort: a per-class histogram over 65,536 hash buckets (a small aggregate)
    gives the boundary bucket; only rows of that bucket are ranked. ``df`` is read three times
    (histogram, boundary, rest): pass a materialised table (parquet, or ``checkpoint()``)."""
    h = split_hash(key, seed)
    d = df.withColumns({"_h": h, "_b": F.conv(F.substring(h, 1, SPLIT_BUCKET_HEX), 16, 10).cast("int")})
    hist = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b")
    cum = hist.select(label, "_b", "_n",
                      F.sum("_n").over(w).alias("_cum"),
                      F.sum("_n").over(Window.partitionBy(label)).alias("_class_n"))
    cum = cum.withColumn("_want", F.floor(F.col("_class_n") * F.lit(test_share) + F.lit(0.5)))
    # boundary: first bucket whose cumulative count reaches the wanted test rows
    cut = (cum.where(F.col("_cum") >= F.col("_want"))
           .groupBy(label).agg(F.min_by(F.struct("_b", (F.col("_want") - F.col("_cum") + F.col("_n")).alias("_need")),
                                        F.col("_b")).alias("_c"))
           .select(label, F.col("_c._b").alias("_cut_b"), F.col("_c._need").alias("_need")))
    # one row per class: broadcast is bounded by the number of classes
    d = d.join(F.broadcast(cut), label, "left")
    inner = d.where(F.col("_b") == F.col("_cut_b"))
    ranked = inner.withColumn("_r", F.row_number().over(Window.partitionBy(label).orderBy("_h", key)))
    boundary = ranked.withColumn("is_test", F.col("_r") <= F.col("_need")).drop("_r")
    rest = d.where((F.col("_b") != F.col("_cut_b")) | F.col("_cut_b").isNull()).withColumn(
        "is_test", F.coalesce(F.col("_b") < F.col("_cut_b"), F.lit(False)))
    return boundary.unionByName(rest).drop("_h", "_b", "_cut_b", "_need")


# --- F05-F10 ---------------------------------------------------------------------------------

def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (classes * n_c), one row per class (tiny)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    classes = F.count(F.lit(1)).over(Window.partitionBy())
    return counts.select(label, (total / (classes * F.col("_n"))).alias(WEIGHT))


def with_class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    return train.join(F.broadcast(class_weights(train, label)), label)


# Buckets per value range and step of the exact median.
MEDIAN_BUCKETS = 4096


def exact_medians(train: DataFrame, numeric: list[str], buckets: int = MEDIAN_BUCKETS) -> dict[str, float | None]:
    """Exact interpolated median of each numeric column (missing values left out; None if all are).

    Values are counted once (a distributed aggregate per column and value). Then the range that holds
    a middle value is narrowed step by step: a histogram of ``buckets`` per range finds the bucket,
    whose least and greatest values are the next range, until one value is left. No sort, no sketch,
    no column's values in one task; per step at most ``buckets`` rows for each wanted rank come back."""
    spark = train.sparkSession
    long = (train.select(*[F.col(c).cast("double").alias(c) for c in numeric])
            .unpivot([], numeric, "feature", "value").where(F.col("value").isNotNull() & ~F.isnan("value")))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranges = {}
        for r in counts.groupBy("feature").agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect():
            for side, rank in (("lower", (r["n"] - 1) // 2), ("upper", r["n"] // 2)):
                ranges[r["feature"], side] = (rank, r["lo"], r["hi"])
        while open_ := [(f, s, lo, hi) for (f, s), (_, lo, hi) in ranges.items() if lo < hi]:
            wanted = spark.createDataFrame(open_, "feature string, side string, lo double, hi double")
            # two rows per column at most
            d = counts.join(F.broadcast(wanted), "feature").where(F.col("value").between(F.col("lo"), F.col("hi")))
            bucket = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets), F.lit(buckets - 1))
            found = (d.groupBy("feature", "side", bucket.alias("bucket"))
                     .agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect())
            for f, s, _, _ in open_:
                rank = ranges[f, s][0]
                for r in sorted((r for r in found if (r["feature"], r["side"]) == (f, s)), key=lambda r: r["bucket"]):
                    if rank < r["n"]:
                        ranges[f, s] = (rank, r["lo"], r["hi"])
                        break
                    rank -= r["n"]
    finally:
        counts.unpersist()
    return {c: (ranges[c, "lower"][1] + ranges[c, "upper"][1]) / 2 if (c, "lower") in ranges else None for c in numeric}


def fitted_stats(model: PipelineModel, numeric: list[str]) -> list[tuple[str, float, float, float]]:
    """(feature, median, mean, standard deviation) as the fitted pipeline applies them: the
    medians come from its own first stage, fed with a row of missing values."""
    spark = SparkSession.getActiveSession()
    first = model.stages[0]
    known = re.findall(r"(\w+)__(?:num|cat)\b", first.getStatement())
    empty = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in dict.fromkeys(known)])
    row = first.transform(empty).first()
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    return [(c, row[f"{c}__num"], float(m), float(d)) for c, m, d in zip(numeric, scaler.mean.toArray(), scaler.std.toArray())]


def categorical_modes(train: DataFrame, categorical: list[str]) -> dict[str, str]:
    """Most frequent value per categorical column (ties: smallest value), from the train part. Values
    are counted by a distributed aggregate; one row per column comes back."""
    counts = (train.select(*[F.col(c).cast("string").alias(c) for c in categorical])
              .unpivot([], categorical, "feature", "value").where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("k"), "value"))["value"].alias("value"))
    found = {r["feature"]: r["value"] for r in best.collect()}
    return {c: found.get(c) for c in categorical}


def _quote(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def build_pipeline(train: DataFrame, model: str = "forest", numeric: list[str] | None = None,
                   categorical: list[str] | None = None) -> Pipeline:
    """Preprocessing + classifier. ``model`` is 'forest' or 'logistic'."""
    num, cat = feature_columns(train)
    num = numeric or num
    cat = categorical or cat
    modes = categorical_modes(train, cat)
    medians = exact_medians(train, num)
    select = ", ".join(
        [f"coalesce(CAST({c} AS DOUBLE), CAST({medians[c]!r} AS DOUBLE)) AS {c}__num" if medians[c] is not None
         else f"CAST({c} AS DOUBLE) AS {c}__num" for c in num]
        + [f"coalesce(CAST({c} AS STRING), {_quote(modes[c]) if modes[c] is not None else 'NULL'}) AS {c}__cat"
           for c in cat])
    stages = [
        SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}__num" for c in num], outputCol="_num_vec", handleInvalid="keep"),
        StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=[f"{c}__cat" for c in cat], outputCols=[f"{c}__idx" for c in cat],
                      handleInvalid="keep", stringOrderType="frequencyDesc"),
        # the indexer's "keep" slot is the last index; dropLast removes exactly that slot, so an
        # unseen category encodes as all zeros (encoder handleInvalid stays "error": "keep" there
        # would give unseen values a slot of their own)
        OneHotEncoder(inputCols=[f"{c}__idx" for c in cat], outputCols=[f"{c}__ohe" for c in cat],
                      dropLast=True),
        VectorAssembler(inputCols=["_num_scaled"] + [f"{c}__ohe" for c in cat], outputCol="features"),
    ]
    if model == "forest":
        clf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol=WEIGHT,
                                     maxBins=FOREST_BINS, **FOREST_PARAMS, **FOREST_TUNING)
    elif model == "logistic":
        n_train = train.count()
        # L2 strength 1/n equals C = 1 on the summed loss; the tolerance and the penalty on the
        # unscaled coefficients follow the original solver defaults (inputs are already scaled)
        clf = LogisticRegression(labelCol=LABEL, featuresCol="features", weightCol=WEIGHT,
                                 maxIter=LOGISTIC_MAX_ITER, regParam=1.0 / max(n_train, 1),
                                 tol=LOGISTIC_TOL, standardization=False)
    else:
        raise ValueError(f"unknown model {model!r}")
    return Pipeline(stages=stages + [clf])


def fit(train: DataFrame, model: str = "forest") -> PipelineModel:
    """F10 (fit): pipeline fitted on the weighted train part (pass a written table). It is cached while a logistic
    regression is fitted; a forest caches its own bagged rows, beside which another copy would only push those to disk."""
    weighted = with_class_weights(train)
    if model == "forest":
        return without_summary(build_pipeline(weighted, model).fit(weighted))
    weighted.persist()
    try:
        return without_summary(build_pipeline(weighted, model).fit(weighted))
    finally:
        weighted.unpersist()


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model without its classifier's training summary. The summary holds the session, which goes with
    the model into every task and can't be sent any more once an ``Observation`` was used in it."""
    fitted = model.stages[-1]
    fitted._java_obj.setSummary(SparkSession.getActiveSession()._jvm.scala.Option.empty())
    return model


def predict(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """F10 (predict) / F15: predicted flag and probability of the late class."""
    keep = keep if keep is not None else [c for c in (ML_ID, LABEL) if c in df.columns]
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").alias("prediction"),
                      vector_to_array("probability")[1].alias("late_probability"))


# --- F11-F12, F16 evaluation -----------------------------------------------------------------

def confusion_matrix(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """rows = true class, columns = predicted 0 / 1; empty cells 0."""
    return (pred.groupBy(F.col(label).cast("int").alias("true_label"))
            .agg(F.count_if(F.col(prediction) == 0).alias("predicted_0"),
                 F.count_if(F.col(prediction) == 1).alias("predicted_1")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p, r):
    return F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """precision, recall, F1 and support per class, accuracy, macro and weighted means
    (0/0 -> 0). One aggregation over the predictions, then arithmetic on one row."""
    y, p = F.col(label), F.col(prediction)
    c = pred.agg(*[agg for k in (0, 1) for agg in (
        F.count_if((y == k) & (p == k)).alias(f"tp{k}"),
        F.count_if(y == k).alias(f"sup{k}"),
        F.count_if(p == k).alias(f"pred{k}"))])
    for k in (0, 1):
        c = c.withColumns({f"p{k}": _safe_div(F.col(f"tp{k}"), F.col(f"pred{k}")),
                           f"r{k}": _safe_div(F.col(f"tp{k}"), F.col(f"sup{k}"))})
        c = c.withColumn(f"f{k}", _f1(F.col(f"p{k}"), F.col(f"r{k}")))
    total = F.col("sup0") + F.col("sup1")
    wavg = lambda m: _safe_div(F.col(f"{m}0") * F.col("sup0") + F.col(f"{m}1") * F.col("sup1"), total)
    rows = [
        c.select(F.lit("0").alias("class_label"), F.col("p0").alias("precision"), F.col("r0").alias("recall"),
                 F.col("f0").alias("f1_score"), F.col("sup0").alias("support")),
        c.select(F.lit("1").alias("class_label"), F.col("p1").alias("precision"), F.col("r1").alias("recall"),
                 F.col("f1").alias("f1_score"), F.col("sup1").alias("support")),
        c.select(F.lit("accuracy").alias("class_label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 _safe_div(F.col("tp0") + F.col("tp1"), total).alias("f1_score"), total.alias("support")),
        c.select(F.lit("macro avg").alias("class_label"), ((F.col("p0") + F.col("p1")) / 2).alias("precision"),
                 ((F.col("r0") + F.col("r1")) / 2).alias("recall"), ((F.col("f0") + F.col("f1")) / 2).alias("f1_score"),
                 total.alias("support")),
        c.select(F.lit("weighted avg").alias("class_label"), wavg("p").alias("precision"), wavg("r").alias("recall"),
                 wavg("f").alias("f1_score"), total.alias("support")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def late_class_summary(pred: DataFrame, model_name: str, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """F16 row: recall, precision, F1 of the late class, false positives and negatives."""
    y, p = F.col(label), F.col(prediction)
    c = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(F.lit(model_name).alias("model"), rec.alias("recall_late"), prec.alias("precision_late"),
                    _f1(prec, rec).alias("f1_late"), F.col("fp").alias("false_positives"),
                    F.col("fn").alias("false_negatives"))


def compare_models(summaries: list[DataFrame]) -> DataFrame:
    """F16: one row per model, best F1 of the late class first."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out.orderBy(F.col("f1_late").desc(), "model")


# --- F13-F14 persistence -------------------------------------------------------------------------

def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | None:
    """the saved pipeline model, or None when there is none at ``path``. A model that is there but
    can't be read raises."""
    spark = SparkSession.getActiveSession()
    return PipelineModel.load(path) if path_exists(spark, path) else None


def save_metrics(report: DataFrame, matrix: DataFrame, path: str, run_id: str) -> str:
    """classification report and confusion matrix as one parquet table keyed by run; writing a
    run again replaces its rows."""
    rep = report.select(F.lit(run_id).alias("run_id"), F.lit("report").alias("kind"), "class_label",
                        "precision", "recall", "f1_score", F.col("support").cast("bigint").alias("support"),
                        F.lit(None).cast("bigint").alias("predicted_0"), F.lit(None).cast("bigint").alias("predicted_1"))
    mat = matrix.select(F.lit(run_id).alias("run_id"), F.lit("confusion").alias("kind"),
                        F.col("true_label").cast("string").alias("class_label"),
                        F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"),
                        F.lit(None).cast("double").alias("f1_score"), F.lit(None).cast("bigint").alias("support"),
                        "predicted_0", "predicted_1")
    (rep.unionByName(mat).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .partitionBy("run_id").parquet(path))
    return path
