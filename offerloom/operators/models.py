"""Models by MLlib: boosted trees for pairs, word vectors for titles, clusters of titles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.operators import skipgram
from offerloom.operators.dataset import seeded
from offerloom.operators.evaluation import class_weight


def assembled(pairs: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(pairs)


def train_trees(pairs: DataFrame, features: list[str], validation: str = "is_validation", rounds: int = 20, depth: int = 4) -> GBTClassificationModel:
    """Weighted boosted trees with early stopping on the rows that `validation` marks."""
    weight = class_weight(pairs).first()["weight"] or 1.0
    rows = assembled(pairs, features).withColumn("weight", F.when(F.col("label") == 1, float(weight)).otherwise(1.0))
    return GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", validationIndicatorCol=validation, maxIter=rounds, maxDepth=depth, seed=1).fit(rows)


def search_trees(pairs: DataFrame, features: list[str], depths: list[int], rounds: list[int], folds: int = 5, seed: int = 1) -> CrossValidatorModel:
    """The best of a grid by area under the precision-recall curve, with folds stratified by label through a seeded hash."""
    trees = GBTClassifier(labelCol="label", featuresCol="features", seed=seed)
    grid = ParamGridBuilder().addGrid(trees.maxDepth, depths).addGrid(trees.maxIter, rounds).build()
    fold = F.pmod(F.conv(F.substring(seeded(seed, "offer_id", "product_id"), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")
    rows = assembled(pairs, features).withColumn("fold", fold)
    return CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(metricName="areaUnderPR"), numFolds=folds, foldCol="fold").fit(rows)


def scored(pairs: DataFrame, model: GBTClassificationModel, features: list[str]) -> DataFrame:
    """pairs with `score`, the probability of label 1."""
    out = model.transform(assembled(pairs, features))
    return out.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).drop("features", "rawPrediction", "probability", "prediction")


def importances(model: GBTClassificationModel, features: list[str], n: int) -> list[tuple[str, float]]:
    return sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))[:n]


#: Titles that one task learns word vectors from; tasks learn side by side, and a word's vectors are averaged.
TITLES_PER_TASK = 5_000


def word_vectors(titles: DataFrame, words: str, size: int = 100, window: int = 5, least: int = 5, rounds: int = 1) -> skipgram.WordVectors:
    """Skip-gram vectors; their transform() gives the mean vector of a title."""
    tasks = -(-titles.count() // TITLES_PER_TASK) or 1
    return skipgram.learn(titles, words, size, window, least, rounds, tasks)


def title_word_vectors(titles: DataFrame, vectors: DataFrame, key: str, words: str) -> DataFrame:
    """Each title's word vectors in order; a word's vector is looked up once per distinct word and title."""
    each = titles.select(key, F.posexplode(words).alias("at", "word"))
    rows = each.join(vectors.select("word", vector_to_array("vector").alias("v")), "word")
    return rows.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("vectors"))


def clusters(rows: DataFrame, features: list[str], ks: list[int], components: int | None = None) -> list[tuple[int, float, DataFrame]]:
    """(k, silhouette, rows with `cluster`) for each k, over scaled features, with their main components if asked for."""
    steps = [VectorAssembler(inputCols=features, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True)]
    column = "scaled"
    if components:
        steps.append(PCA(k=components, inputCol="scaled", outputCol="main"))
        column = "main"
    prepared = Pipeline(stages=steps).fit(rows).transform(rows)
    out = []
    for k in ks:
        found = KMeans(k=k, seed=1, featuresCol=column, predictionCol="cluster").fit(prepared).transform(prepared)
        out.append((k, ClusteringEvaluator(featuresCol=column, predictionCol="cluster").evaluate(found), found.drop("raw", "scaled", "main")))
    return out
