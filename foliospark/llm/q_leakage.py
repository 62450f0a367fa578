"""p6: pictures of the validation and test splits that occur on the training side."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read_table
from .leakage import cross_split_pairs, record_pairs
from .queries import LLM


def _pairs(spark, sf_dir):
    return record_pairs(*cross_split_pairs(read_table(spark, sf_dir, "line_images")))


@LLM.add("p6_found")
def p6_found(spark, sf_dir):
    """Pairs of images, one on each side, that show the same picture."""
    p = _pairs(spark, sf_dir)
    return p.select(F.least("eval_id", "train_id").alias("image_a"), F.greatest("eval_id", "train_id").alias("image_b")).distinct()


@LLM.add("p6_report")
def p6_report(spark, sf_dir):
    """Overlaps for each evaluation split and source: pairs, how many of them with equal transcriptions, records concerned, mean coverage."""
    split = F.lower(F.trim("eval_split"))
    p = _pairs(spark, sf_dir).withColumn("split", F.when(split == "val", "validation").otherwise(split))
    per = p.groupBy("split", F.col("eval_source").alias("source"), "eval_id").agg(F.countDistinct("train_id").alias("n"), F.countDistinct(F.when(F.col("same_text"), F.col("train_id"))).alias("n_same"), F.max("coverage").alias("coverage"))
    return per.groupBy("split", "source").agg(F.sum("n").alias("n_pairs"), F.sum("n_same").alias("n_same_text"), F.count("*").alias("n_records"), F.avg("coverage").alias("mean_coverage"))
