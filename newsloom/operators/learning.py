"""Models trained on the cluster: k-means over directions, a text classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, NGram, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spherical_kmeans(df: DataFrame, k: int, ident: str = "vec_id", vector: str = "embedding", sample: float = 1.0, seed: int = 7) -> DataFrame:
    """Cluster of every vector by direction. sample: share used to fit; every vector is assigned. Null and zero vectors are left out."""
    v = df.filter(F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0)).select(ident, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    fit = v.sample(sample, seed) if sample < 1 else v
    return KMeans(k=k, seed=seed, distanceMeasure="cosine").fit(fit).transform(v).select(ident, F.col("prediction").alias("cluster"))


def text_classifier(train: DataFrame, label: str, text: str, features: int = 1 << 16) -> PipelineModel:
    """Words and word pairs, hashed and weighted by rarity, into a multinomial logistic regression."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="__y", handleInvalid="skip"),
            RegexTokenizer(inputCol=text, outputCol="__w", pattern=r"[^\p{L}\p{N}]+"),
            NGram(n=2, inputCol="__w", outputCol="__g"),
            SQLTransformer(statement="SELECT *, concat(__w, __g) AS __t FROM __THIS__"),
            HashingTF(inputCol="__t", outputCol="__tf", numFeatures=features),
            IDF(inputCol="__tf", outputCol="__x"),
            VectorAssembler(inputCols=["__x"], outputCol="__features"),
            LogisticRegression(featuresCol="__features", labelCol="__y", maxIter=15, regParam=0.01),
        ]
    ).fit(train)


def classify(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Predicted label and its probability for every row."""
    from pyspark.ml.functions import vector_to_array

    labels = F.array(*map(F.lit, model.stages[0].labels))
    words = PipelineModel(model.stages[1:]).transform(df)
    return words.select(*keep, F.get(labels, F.col("prediction").cast("int")).alias("predicted"), F.array_max(vector_to_array("probability")).alias("score"))
