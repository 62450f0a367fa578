"""p9: documents in containers of 2,048 tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read_table, stage
from .packing import CAPACITY, pack
from .queries import LLM
from .tokens import count_tokens


def _bins(spark, sf_dir):
    sizes = stage(count_tokens(read_table(spark, sf_dir, "documents"), "doc_id", "text"))  # tokenised once, used twice
    return pack(sizes, "doc_id", "n_tokens")


@LLM.add("p9_containers")
def p9_containers(spark, sf_dir):
    """Each document with its container, place in it and first token there."""
    return _bins(spark, sf_dir)


@LLM.add("p9_fill")
def p9_fill(spark, sf_dir):
    """How full the containers are."""
    c = _bins(spark, sf_dir).groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return c.agg(F.count("*").alias("containers"), F.min("used").alias("least"), (F.sum("used") / (F.count("*") * F.lit(CAPACITY))).alias("fill"))
