"""Disruption-risk models on Spark ML, and the data work around them.

* feature frame: ten pre-departure features + label, rows with any NULL dropped;
* exact stratified 80/20 split: per class, rows ordered by ``md5(seed | key)``
  and the first ``test_c`` of each class go to test, where ``test_c`` follows the
  largest-remainder allocation of a stratified shuffle split.  A histogram of hash
  prefixes gives each class's threshold; only the rows of the prefix on which it
  falls are put in order;
* scaling by the population standard deviation (no centring; divisor 1 for a
  constant column), fitted on train;
* one-hot encoding, categories learnt on train in alphabetical order, an
  unseen category encodes as all zeros;
* balanced class weights ``n / (k * n_c)``;
* logistic regression (L2, C = 1, no standardisation) by Newton's method
  (``newton.py``) and a random forest (150 trees, depth 12, sqrt features) whose
  bagging follows the rows' content, not the partitions they come in;
* metrics: accuracy, precision, recall, F1 of the positive class and the exact
  ROC-AUC (rank statistic with ties counted half), each rounded to 4 places.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.functions import fixed
from aloft.functions.columns import np_round
from aloft.operators import bagging, newton
from aloft.operators.ordered import global_running_sum, written

KEYS = ("OP_CARRIER_FL_NUM", "TAIL_NUM", "FL_DATE")
NUMERIC = tuple(c for c in fixed.ML_FEATURES if c not in fixed.ML_CATEGORICAL)
LABEL = fixed.ML_TARGET
#: hex digits of the hash prefix in the split's histogram
SPLIT_PREFIX = 4


def ml_frame(enriched: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cols = list(keys) + list(fixed.ML_FEATURES) + [LABEL]
    return enriched.select(*cols).dropna(subset=list(fixed.ML_FEATURES) + [LABEL])


def split_hash(seed: int = fixed.ML_SEED, keys: Sequence[str] = KEYS) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def test_allocation(frame: DataFrame, label: str = LABEL,
                    test_fraction: float = fixed.ML_TEST_FRACTION) -> DataFrame:
    """Per class: n_c and the number of test rows (largest remainder, ties by label).

    ``n_test = ceil(f * n)``; train rows per class are ``floor(n_c / n * n_train)``
    plus one for the classes with the largest fractional parts until the
    train total is met; the class keeps the rest for test.  The frame has one
    row per class (size bounded by the number of classes).
    """
    counts = frame.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy()
    n = F.sum("n_c").over(every)
    n_train = n - F.ceil(F.lit(test_fraction) * n)
    cont = (F.col("n_c") / n) * n_train
    a = counts.withColumns({"__cont": cont, "__ntrain": n_train})
    a = a.withColumns({"__floor": F.floor("__cont"), "__rem": F.col("__cont") - F.floor("__cont")})
    a = a.withColumn("__need", F.col("__ntrain") - F.sum("__floor").over(every))
    a = a.withColumn("__rank", F.row_number().over(Window.orderBy(F.col("__rem").desc(), F.col(label))))
    train_c = F.col("__floor") + F.when(F.col("__rank") <= F.col("__need"), 1).otherwise(0)
    return a.select(label, "n_c", (F.col("n_c") - train_c).cast("bigint").alias("test_c"))


def stratified_split(frame: DataFrame, keys: Sequence[str] = KEYS, label: str = LABEL,
                     test_fraction: float = fixed.ML_TEST_FRACTION,
                     seed: int = fixed.ML_SEED) -> DataFrame:
    """Add ``split`` in {'train', 'test'}: exact per-class test counts, hash-ordered choice."""
    frame = written(frame.withColumn("__h", split_hash(seed, keys)), "split")
    alloc = test_allocation(frame, label, test_fraction).select(label, "test_c")
    prefix = F.left("__h", F.lit(SPLIT_PREFIX))
    counts = frame.groupBy(label, prefix.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(label).orderBy("__p"))  # at most 16 ** SPLIT_PREFIX rows a class
    edge = (counts.withColumn("__upto", upto).join(F.broadcast(alloc), label)
            .where((F.col("__upto") >= F.col("test_c")) & (F.col("__upto") - F.col("__n") < F.col("test_c")))
            .select(label, F.col("__p").alias("__edge"), (F.col("test_c") - F.col("__upto") + F.col("__n")).alias("__take")))
    near = frame.join(F.broadcast(edge), label, "left").withColumn("__p", prefix)
    place = Window.partitionBy(label).orderBy("__h", *keys, *[c for c in frame.columns if c not in (*keys, label, "__h")])
    on_edge = near.where(F.col("__p") == F.col("__edge"))
    ranked = on_edge.withColumn("split", F.when(F.row_number().over(place) <= F.col("__take"), "test")
                                .otherwise("train"))
    rest = near.where(F.col("__edge").isNull() | (F.col("__p") != F.col("__edge"))).withColumn(
        "split", F.when(F.col("__p") < F.col("__edge"), "test").otherwise("train"))
    return rest.unionByName(ranked).drop("__h", "__p", "__edge", "__take")


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy()
    n, k = F.sum("n_c").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def scale_stats(train: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """One row: population std of each column; 1.0 where the column is constant or empty."""
    return train.agg(*[
        F.coalesce(F.when(F.max(c) != F.min(c), F.stddev_pop(F.col(c).cast("double"))), F.lit(1.0)).alias(f"__sd_{c}")
        for c in cols])


def standard_scale(df: DataFrame, stats: DataFrame, cols: Sequence[str] = NUMERIC,
                   suffix: str = "") -> DataFrame:
    joined = df.crossJoin(F.broadcast(stats))
    return joined.withColumns({f"{c}{suffix}": F.col(c).cast("double") / F.col(f"__sd_{c}")
                               for c in cols}).drop(*[f"__sd_{c}" for c in cols])


def fit_indexers(train: DataFrame, cols: Sequence[str] = fixed.ML_CATEGORICAL):
    """One StringIndexer over all categorical columns: a single pass over ``train``."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols],
                         handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)


def _labels(indexers) -> list[list[str]]:
    return [list(x) for x in indexers.labelsArray]


def one_hot_long(df: DataFrame, indexers, keys: Sequence[str],
                 cols: Sequence[str] = fixed.ML_CATEGORICAL) -> DataFrame:
    """Long form of the one-hot encoding: one (keys.., feature) row per active entry.

    A value not seen in training has no active entry (all-zero block)."""
    indexed = indexers.transform(df)
    active = []
    for c, labels in zip(cols, _labels(indexers)):
        idx = F.col(f"{c}__idx").cast("int")
        active.append(F.when(idx < len(labels), F.concat(F.lit(f"{c}_"), F.col(c))).cast("string"))
    out = indexed.select(*keys, F.explode(F.array(*active)).alias("feature"))
    return out.where(F.col("feature").isNotNull()).withColumn("value", F.lit(1.0))


def feature_names(indexers, num: Sequence[str] = NUMERIC,
                  cols: Sequence[str] = fixed.ML_CATEGORICAL) -> list[str]:
    names = list(num)
    for c, labels in zip(cols, _labels(indexers)):
        names += [f"{c}_{v}" for v in labels]
    return names


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    indexers: object
    names: list[str]
    assemble: Callable[[DataFrame], DataFrame]  # adds the vector ``features`` to a feature frame


def prepare(frame_with_split: DataFrame) -> Prepared:
    """Scaled numeric + one-hot vector ``features`` and balanced ``weight`` for both splits; ``place``, a
    hash of the training row's content, for the forest."""
    content = [c for c in frame_with_split.columns if c != "split"]
    frame_with_split = frame_with_split.withColumn("place", F.xxhash64(*content))
    train = frame_with_split.where(F.col("split") == "train")
    test = frame_with_split.where(F.col("split") == "test")
    stats = scale_stats(train)
    weights = class_weights(train).select(LABEL, "weight")
    indexers = fit_indexers(train)
    encoders = OneHotEncoder(inputCols=[f"{c}__idx" for c in fixed.ML_CATEGORICAL],
                             outputCols=[f"{c}__ohe" for c in fixed.ML_CATEGORICAL], dropLast=True)
    assembler = VectorAssembler(inputCols=[f"{c}__sc" for c in NUMERIC]
                                + [f"{c}__ohe" for c in fixed.ML_CATEGORICAL], outputCol="features")

    def build(df: DataFrame) -> DataFrame:
        return indexers.transform(standard_scale(df, stats, suffix="__sc"))

    enc = encoders.fit(build(train))

    def assemble(df: DataFrame) -> DataFrame:
        return assembler.transform(enc.transform(build(df)))

    def weighted(df: DataFrame) -> DataFrame:
        return assemble(df).join(F.broadcast(weights), LABEL)  # a row for each class

    return Prepared(weighted(train).select("features", LABEL, "weight", "place"),
                    weighted(test).select("features", LABEL, "weight"), indexers, feature_names(indexers), assemble)


def vectors_long(assembled: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The entries of assembled vectors that are not 0: one (keys.., feature, value) row each."""
    u = F.unwrap_udt("features")
    at = F.when(u["type"] == newton.DENSE, F.sequence(F.lit(0), F.size(u["values"]) - 1)).otherwise(u["indices"])
    entries = assembled.select(*keys, F.explode(F.arrays_zip(at.alias("at"), u["values"].alias("v"))).alias("e"))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("e.at") + 1)
    return entries.where("e.v <> 0").select(*keys, named.alias("feature"), F.round("e.v", 6).alias("value"))


def logistic(train: DataFrame, max_iter: int = fixed.LR_MAX_ITER) -> newton.Logistic:
    return newton.fit(train, LABEL, "weight", max_iter)


def forest(train: DataFrame, trees: int = fixed.RF_TREES, depth: int = fixed.RF_MAX_DEPTH,
           seed: int = fixed.ML_SEED):
    """A forest of bagged trees (``bagging.py``); bags follow ``place`` (a hash of the row's content, made here from the
    vector if it is not there), so the same rows give the same trees, however they came."""
    if "place" not in train.columns:
        u = F.unwrap_udt("features")
        train = train.withColumn("place", F.xxhash64(u["type"], u["size"], u["indices"], u["values"], LABEL))
    return bagging.fit(train, LABEL, "weight", trees, depth, seed)


def scored(model, test: DataFrame) -> DataFrame:
    """(label, pred, score) of a fitted model."""
    if isinstance(model, newton.Logistic):
        out = test.select(F.col(LABEL).alias("label"), model.score("features").alias("score"))
        return out.select("label", (F.col("score") > 0.5).cast("int").alias("pred"), "score")
    return model.scored(test, LABEL)


def logistic_gradient(prepared: Prepared, model: newton.Logistic) -> DataFrame:
    """(feature, gradient) at the fit, to six places: 0 everywhere if the fit is the minimum."""
    names = prepared.test.sparkSession.createDataFrame(list(enumerate([*prepared.names, "(intercept)"])), "i int, feature string")
    found = newton.gradient(prepared.train, model, LABEL, "weight")
    return names.join(found, "i", "left").select("feature", F.abs(F.round("gradient", 6)).alias("gradient"))


def confusion(pred: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, tn (label and pred are 0/1; column ``n``, if there, counts equal rows)."""
    n = F.col("n") if "n" in pred.columns else F.lit(1)
    hit = lambda label, p: F.coalesce(F.sum(F.when((F.col("label") == label) & (F.col("pred") == p), n)),
                                      F.lit(0)).cast("bigint")
    return pred.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))


def _div0(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def score_counts(pred: DataFrame) -> DataFrame:
    """(label, pred, score, n), staged: everything the metrics need, scored once."""
    return written(pred.groupBy("label", "pred", "score").agg(F.count(F.lit(1)).alias("n")), "scores")


def exact_auc(pred: DataFrame) -> DataFrame:
    """One row ``roc_auc``: P(score_pos > score_neg) + 0.5 P(equal), exactly.

    Rows collapse to one per distinct score first (partial aggregation), then a
    distributed running sum of negatives over the score order gives, for every
    score, the negatives ranked below it.  Products are doubles: the number of
    pairs passes a long's range at a few billion rows.
    """
    n = F.col("n") if "n" in pred.columns else F.lit(1)
    per_score = pred.groupBy("score").agg(
        F.sum(F.when(F.col("label") == 1, n).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col("label") == 0, n).otherwise(0)).cast("bigint").alias("neg"))
    run = global_running_sum(per_score, ["score"], {"neg": "neg_upto"})
    part = run.select((F.col("pos").cast("double")
                       * ((F.col("neg_upto") - F.col("neg")).cast("double") + F.col("neg") * 0.5))
                      .alias("u"), "pos", "neg")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return part.agg(_div0(F.sum("u"), pairs).alias("roc_auc"))


def binary_metrics(pred: DataFrame, model_name: str | None = None) -> DataFrame:
    pred = pred if "n" in pred.columns else score_counts(pred)
    c = confusion(pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    metrics = c.crossJoin(exact_auc(pred)).select(
        np_round(_div0(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        np_round(_div0(tp, tp + fp), 4).alias("precision"),
        np_round(_div0(tp, tp + fn), 4).alias("recall"),
        np_round(_div0(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        np_round(F.col("roc_auc"), 4).alias("roc_auc"))
    if model_name is not None:
        metrics = metrics.select(F.lit(model_name).alias("model"), *metrics.columns)
    return metrics


def classification_report(pred: DataFrame) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion(pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    # class 1 counts as positive; for class 0 the roles swap
    rows = c.select(
        F.lit("Not Disrupted").alias("label"), _div0(tn, tn + fn).alias("precision"),
        _div0(tn, tn + fp).alias("recall"), _div0(2 * tn, 2 * tn + fn + fp).alias("f1_score"),
        (tn + fp).alias("support"), F.lit(1).alias("ord"),
    ).unionByName(c.select(
        F.lit("Disrupted").alias("label"), _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        (tp + fn).alias("support"), F.lit(2).alias("ord")))
    acc = c.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"),
                   _div0(tp + tn, n).alias("f1_score"), n.alias("support"), F.lit(3).alias("ord"))
    macro = rows.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                     F.sum("support").alias("support"), F.lit(4).alias("ord"))
    weighted = rows.agg(
        F.lit("weighted avg").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("f1_score"),
        F.sum("support").alias("support"), F.lit(5).alias("ord"))
    out = rows.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.withColumn("support", F.col("support").cast("bigint")).orderBy("ord").drop("ord")


def importances(spark, model, names: Sequence[str], top: int = fixed.TOP_FEATURES) -> DataFrame:
    """Top-``top`` feature importances with readable names.

    The importance vector lives on the driver as part of the fitted model; its
    size is the number of features, not of rows."""
    values = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, values), key=lambda t: (-t[1], t[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")
