"""p10: scores of abusive, hateful or sexual content and rates per source."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import read_table
from .queries import LLM
from .toxicity import MAX_CHARS, MAX_NEGATIVE, MAX_POSITIVE, Scorer, train


def labelled_sample(docs: DataFrame, labels: DataFrame, max_chars: int = MAX_CHARS) -> list:
    """At most MAX_POSITIVE marked and MAX_NEGATIVE unmarked documents, in hash order; a document marked once is marked.

    Of these so many, marked ones first, as have at most ``max_chars`` characters together, so what comes to the driver is bounded.
    """
    mark = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    some = mark.where("toxic = 1").orderBy(order).limit(MAX_POSITIVE).union(mark.where("toxic = 0").orderBy(order).limit(MAX_NEGATIVE))
    texts = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    so_far = Window.partitionBy(F.lit(0)).orderBy(F.col("toxic").desc(), F.col("h")).rowsBetween(Window.unboundedPreceding, 0)  # a bounded number of rows
    lengths = texts.select("doc_id", "toxic", order.alias("h"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n")).withColumn("upto", F.sum("n").over(so_far))
    kept = lengths.where(F.col("upto") <= max_chars).select("doc_id")
    return texts.join(F.broadcast(kept), "doc_id", "left_semi").orderBy("doc_id").collect()


_trained: dict[str, tuple] = {}


def model_of(rows: list) -> tuple:
    """Parameters and threshold trained on labelled rows; the same rows train once in a session, for all queries."""
    digest = hashlib.sha256()
    for r in rows:
        digest.update(f"{r['doc_id']}|{r['toxic']}|{len(r['text'] or '')}|".encode() + (r["text"] or "").encode("utf-8", "replace"))
    key = digest.hexdigest()
    if key not in _trained:
        _trained.clear()  # one model is kept
        _trained[key] = train([r["text"] for r in rows], [int(r["toxic"]) for r in rows])
    return _trained[key]


def scored(spark, sf_dir) -> tuple[DataFrame, float]:
    """``doc_id, source, score`` of every document and the threshold; null, empty and blank texts score 0."""
    docs = read_table(spark, sf_dir, "documents")
    rows = labelled_sample(docs, read_table(spark, sf_dir, "labels"))
    params, threshold = model_of(rows)
    model = spark.sparkContext.broadcast(params)  # of fixed size

    def run(batches):
        scorer = Scorer(model.value) if model.value else None
        for b in batches:
            texts = b.column(2).to_pylist()
            scores = scorer.documents(texts) if scorer else [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64())], ["doc_id", "source", "score"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, source string, score double"), threshold


@LLM.add("p10_found")
def p10_found(spark, sf_dir):
    """The documents with such a passage."""
    s, threshold = scored(spark, sf_dir)
    return s.where(F.col("score") >= threshold).select("doc_id")


@LLM.add("p10_scores")
def p10_scores(spark, sf_dir):
    """The score of every document."""
    return scored(spark, sf_dir)[0].select("doc_id", F.round("score", 6).alias("score"))


@LLM.add("p10_rates")
def p10_rates(spark, sf_dir):
    """Documents, flagged documents and their share for each source."""
    s, threshold = scored(spark, sf_dir)
    flag = (F.col("score") >= threshold).cast("bigint")
    return s.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(flag).alias("n_flagged"), F.avg(flag).alias("rate"), F.avg("score").alias("mean_score"))
