"""Text weights and clusters' terms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, RegexTokenizer, StopWordsRemover)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill import vocab
from listingmill.functions import text as tx


def _terms(docs: DataFrame, words: Column, stop_words: Sequence[str], *keys: str) -> DataFrame:
    """One row per word that is not a stop word."""
    return docs.select(*keys, F.explode(words).alias("term")).where(~F.col("term").isin(*stop_words))


def _vocabulary(terms: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms, equal counts by term."""
    return (
        terms.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), "term").limit(max_features).select("term")
    )


def tfidf(docs: DataFrame, key: str = "doc_id", text: str = "text", max_features: int = 1000,
          stop_words: Sequence[str] = vocab.STOP_WORDS) -> DataFrame:
    """TF-IDF in long form: (key, term, weight).

    Lower-cased words of two or more characters without stop words; the
    vocabulary is the ``max_features`` most frequent terms of the corpus (equal
    counts by term); idf is ln((1+n)/(1+df))+1 and every document has length 1.

    Two passes over the texts: the first only shuffles counts per term, the
    second only words of the vocabulary.
    """
    terms = _terms(docs, tx.words(F.coalesce(F.col(text), F.lit(""))), stop_words, key)
    vocabulary = _vocabulary(terms, max_features)
    per_doc = (
        terms.join(F.broadcast(vocabulary), "term")  # max_features rows
        .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    frequency = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    size = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    weighted = (
        per_doc.join(F.broadcast(frequency), "term")  # max_features rows
        .withColumn("weight", F.col("tf") * (F.log((size + 1.0) / (F.col("df") + 1.0)) + 1.0))
    )
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy(key)))
    return weighted.select(key, "term", (F.col("weight") / length).alias("weight"))


def cluster_top_terms(weights: DataFrame, labels: DataFrame, n: int = 10, key: str = "doc_id",
                      cluster: str = "cluster") -> DataFrame:
    """Terms with the highest mean weight per cluster: (cluster, rank, term).

    A document without the term counts with weight 0.
    """
    sizes = labels.groupBy(cluster).agg(F.count(F.lit(1)).alias("docs"))
    sums = weights.join(labels.select(key, cluster), key).groupBy(cluster, "term").agg(F.sum("weight").alias("w"))
    best = W.partitionBy(cluster).orderBy(F.desc(F.round("mean_weight", 9)), "term")
    return (
        sums.join(sizes, cluster)
        .withColumn("mean_weight", F.col("w") / F.col("docs"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
        .select(cluster, F.col("rank").cast("bigint").alias("rank"), "term")
    )


def joined_terms(top: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row per cluster with its terms in rank order, comma-separated."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return top.groupBy(cluster).agg(F.array_join(F.transform(ordered, lambda x: x["term"]), ", ").alias("top_terms"))


def text_vectoriser(docs: DataFrame, text: str = "description", max_features: int = 1000,
                    stop_words: Sequence[str] = vocab.STOP_WORDS) -> PipelineModel:
    """The same weights as sparse vectors (``text_vec``), as a fitted pipeline.

    Vocabulary and document counts (at most ``max_features`` rows) come from
    two aggregates; a vector is the term counts scaled by idf, at length 1.
    """
    words = tx.words(F.coalesce(F.col(text), F.lit("")))
    vocabulary = _vocabulary(_terms(docs, words, stop_words), max_features)
    once = _terms(docs, F.array_distinct(words), stop_words)
    counted = dict(
        once.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect())
    terms, size = sorted(counted), docs.count()
    count = CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_counts")
    scale = [math.log((1 + size) / (1 + counted[t])) + 1 for t in terms]
    return PipelineModel(stages=[
        RegexTokenizer(inputCol="_text", outputCol="_words", gaps=False, pattern=tx.WORD + "{2,}"),
        StopWordsRemover(inputCol="_words", outputCol="_terms", stopWords=list(stop_words)),
        count,
        ElementwiseProduct(inputCol="_counts", outputCol="_weights", scalingVec=scale),
        Normalizer(inputCol="_weights", outputCol="text_vec", p=2.0),
    ])


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))


#: Columns between the stages of a text pipeline.
INTERNAL = ("_text", "_words", "_terms", "_counts", "_weights")


def cluster_texts(docs: DataFrame, text: str = "description", k: int = 10, seed: int = 42,
                  max_features: int = 1000) -> tuple[DataFrame, PipelineModel]:
    """``description_cluster`` from k-means on text weights, with the fitted
    pipeline that assigns new texts."""
    vectors = text_vectoriser(docs, text, max_features)
    features = vectors.transform(_with_text(docs, text)).drop(*INTERNAL)
    kmeans = KMeans(k=k, seed=seed, featuresCol="text_vec", predictionCol="description_cluster").fit(features)
    model = PipelineModel(stages=[*vectors.stages, kmeans])
    return kmeans.transform(features), model


def assign_text_cluster(model: PipelineModel, docs: DataFrame, text: str = "description") -> DataFrame:
    return model.transform(_with_text(docs, text)).drop(*INTERNAL)
