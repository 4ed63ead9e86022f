"""Classical models with Spark ML.

Models train on assembled vectors; everything before the ``VectorAssembler``
stays a wide DataFrame.  Differences to the reference's library that change
numbers are handled explicitly:

* logistic regression ``C``: the reference minimises ``1/2 |w|^2 + C sum_i w_i loss_i``,
  Spark minimises ``sum_i w_i loss_i / sum_i w_i + regParam/2 |w|^2``, so
  ``regParam = 1 / (C * sum_i w_i)`` with ``standardization=False``;
* ``class_weight='balanced'`` -> a weight column ``N / (k n_c)``;
* folds: stratified, the index of a row inside its class (hash order) modulo
  k, so that a class differs by at most one row between folds; passed as
  ``foldCol``.
"""

from __future__ import annotations

import random

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.sample import dense_index_by_class, with_sample_weight


def assemble(df: DataFrame, feature_cols, out_col: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out_col, handleInvalid="keep").transform(df)


def vectors(df: DataFrame, array_col: str, out_col: str = "features") -> DataFrame:
    """S10 at the ML edge: ``ARRAY<FLOAT>`` -> dense vector."""
    return df.withColumn(out_col, array_to_vector(F.col(array_col).cast("array<double>")))


def add_folds(df: DataFrame, k: int, id_col: str = "RecordID", seed: int = 0, out_col: str = "fold",
              label_col: str = "label") -> DataFrame:
    """Stratified fold number ``0..k-1`` of every row."""
    indexed = dense_index_by_class(df, label_col, id_col, seed)
    return indexed.withColumn(out_col, F.pmod(F.col("_idx"), F.lit(k)).cast("int")).drop("_idx")


def balanced(df: DataFrame, label_col: str = "label", weight_col: str = "weight") -> DataFrame:
    """``class_weight='balanced'`` as a weight column."""
    return with_sample_weight(df, label_col, "balanced", weight_col)


def random_forest(n_trees: int = 100, max_depth: int = 10, min_leaf: int = 1, subsample: float = 1.0,
                  weight_col: str | None = None, seed: int = 0, features_col: str = "features",
                  label_col: str = "label") -> RandomForestClassifier:
    """M4: forest with the reference's knobs (``min_samples_split`` has no
    Spark equivalent and is not used).  Spark grows at most 30 levels; a deeper
    setting is refused."""
    if max_depth > 30:
        raise ValueError("Spark's forests have at most 30 levels")
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=n_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                subsamplingRate=subsample, featureSubsetStrategy="sqrt", seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def logistic_regression(C: float, total_weight: float, max_iter: int = 1000, weight_col: str | None = None,
                        features_col: str = "features", label_col: str = "label") -> LogisticRegression:
    """M6: L2 logistic regression with the reference's ``C`` (see module notes)."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                            elasticNetParam=0.0, regParam=1.0 / (C * total_weight), standardization=False,
                            family="binomial")
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def logspace(lo: int = -3, hi: int = 3, n: int = 7) -> list[float]:
    """``10 ** linspace(lo, hi, n)``."""
    return [10 ** (lo + (hi - lo) * i / (n - 1)) for i in range(n)]


def grid_search_lr(train: DataFrame, Cs, k: int = 5, weight_col: str | None = None, seed: int = 0,
                   id_col: str = "RecordID", parallelism: int = 4):
    """M7 + O5: k-fold CV over ``C`` scored by ROC-AUC, refit on all rows with
    the best ``C``.  Returns ``(model, [(C, mean auc)])``."""
    total = (train.agg(F.sum(weight_col)).first()[0] if weight_col else train.count())
    lr = LogisticRegression(elasticNetParam=0.0, standardization=False, maxIter=1000, family="binomial")
    if weight_col:
        lr.setWeightCol(weight_col)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * total * (k - 1) / k) for c in Cs]).build()
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    if weight_col:
        ev.setWeightCol(weight_col)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, foldCol="fold", numFolds=k,
                        parallelism=parallelism, seed=seed)
    scores = list(zip(Cs, cv.fit(add_folds(train, k, id_col, seed)).avgMetrics))
    best = max(scores, key=lambda x: x[1])[0]
    # the penalty is per unit of weight: the refit sees all rows, not a fold's share
    return logistic_regression(best, total, weight_col=weight_col).fit(train), scores


def random_search_rf(train: DataFrame, n_iter: int = 30, k: int = 3, seed: int = 0, id_col: str = "RecordID",
                     label_col: str = "label", parallelism: int = 8):
    """M5: ``n_iter`` seeded random draws of forest settings, k-fold CV scored
    by accuracy, best refit.  Returns ``(model, [(params, mean accuracy)])``.

    Draws follow the reference's search space: trees 100..999, depth 10..19,
    row subsample 0.5/0.75/1.0, min leaf 1..4, balanced weights or none,
    features per split sqrt/log2/all (``min_samples_split`` has no Spark
    counterpart).  The balanced weight column is added once; unweighted
    draws give every row weight 1.
    """
    rng = random.Random(seed)
    data = balanced(train, label_col, "w_balanced").withColumn("w_none", F.lit(1.0))
    data = add_folds(data, k, id_col, seed, label_col=label_col)
    results, best = [], None
    draws = []
    for _ in range(n_iter):
        draws.append({"numTrees": rng.randint(100, 999), "maxDepth": rng.randint(10, 19),
                      "subsamplingRate": rng.choice([0.5, 0.75, 1.0]),
                      "minInstancesPerNode": rng.randint(1, 4),
                      "weightCol": rng.choice(["w_balanced", "w_none"]),
                      "featureSubsetStrategy": rng.choice(["sqrt", "log2", "all"])})
    ev = MulticlassClassificationEvaluator(metricName="accuracy", labelCol=label_col)
    # one CrossValidator per weight column (a param map cannot switch columns)
    for wcol in ("w_balanced", "w_none"):
        idx = [i for i, d in enumerate(draws) if d["weightCol"] == wcol]
        if not idx:
            continue
        rf = RandomForestClassifier(seed=seed, labelCol=label_col, weightCol=wcol)
        maps = [{rf.numTrees: draws[i]["numTrees"], rf.maxDepth: draws[i]["maxDepth"],
                 rf.subsamplingRate: draws[i]["subsamplingRate"],
                 rf.minInstancesPerNode: draws[i]["minInstancesPerNode"],
                 rf.featureSubsetStrategy: draws[i]["featureSubsetStrategy"]} for i in idx]
        cv = CrossValidator(estimator=rf, estimatorParamMaps=maps, evaluator=ev, foldCol="fold", numFolds=k,
                            parallelism=parallelism, seed=seed)
        model = cv.fit(data)
        for i, acc in zip(idx, model.avgMetrics):
            results.append((i, draws[i], acc))
            if best is None or acc > best[0]:
                best = (acc, model.bestModel)
    results.sort(key=lambda t: t[0])
    return best[1], [(d, a) for _, d, a in results]


def feature_importances(model, feature_cols) -> DataFrame:
    """M8 + O4: ``(feature, importance)`` ordered by importance (names match
    the assembled columns, Q-16 fixed)."""
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(feature_cols, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def coefficients(model, feature_cols) -> DataFrame:
    """M9: coefficient per feature (one row per feature; feed to A14 for the histogram)."""
    spark = SparkSession.getActiveSession()
    coef = model.coefficients.toArray().tolist()
    return spark.createDataFrame([(f, float(c)) for f, c in zip(feature_cols, coef)],
                                 "feature string, coefficient double")


def predict(model, df: DataFrame, id_col: str = "RecordID", keep=("label",)) -> DataFrame:
    """Predicted class and P(class 1)."""
    out = model.transform(df)
    return out.select(F.col(id_col), *[F.col(k) for k in keep if k in out.columns],
                      F.col("prediction").cast("int").alias("pred"),
                      vector_to_array("probability")[1].alias("probability"))


def linear_probe(df: DataFrame, vec_col: str = "embedding", label_col: str = "label", max_iter: int = 1000):
    """Unregularised logistic regression on frozen representations of the
    training split, positives weighted by ``n_neg / n_pos`` (the probe's
    pos_weight).  Returns the model and the weighted training vectors."""
    v = vectors(df, vec_col)
    counts = {r[label_col]: r["n"] for r in v.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    pw = counts.get(0, 0) / max(counts.get(1, 1), 1)
    v = v.withColumn("weight", F.when(F.col(label_col) == 1, F.lit(float(pw))).otherwise(F.lit(1.0)))
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, weightCol="weight", regParam=0.0,
                            maxIter=max_iter, family="binomial")
    return lr.fit(v), v


def project_2d(df: DataFrame, vec_col: str = "embedding", id_col: str = "RecordID", keep=("label",)) -> DataFrame:
    """Two-dimensional PCA projection for display (t-SNE is not built)."""
    v = vectors(df, vec_col, "features")
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(v)
    out = model.transform(v).withColumn("_pc", vector_to_array("pc"))
    return out.select(F.col(id_col), *[F.col(k) for k in keep if k in out.columns],
                      F.col("_pc")[0].alias("pc1"), F.col("_pc")[1].alias("pc2"))


__all__ = ["assemble", "vectors", "add_folds", "balanced", "random_forest", "logistic_regression",
           "logspace", "grid_search_lr", "random_search_rf", "feature_importances", "coefficients", "predict",
           "linear_probe", "project_2d"]
