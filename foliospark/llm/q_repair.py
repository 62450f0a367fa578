"""p1: noise in text from scanned pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import norm_id
from ..session import read_table
from .queries import LLM
from .scans import learn, scan

_FIELDS = ["tesseract_text", "htr_text", "merged_text", "htr_output"]


def _scanned(spark, sf_dir, mend: bool):
    docs, regions = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "handwritten_regions")
    digital = F.col("tesseract_text").isNull() & F.col("htr_text").isNull()
    whole = F.coalesce("merged_text", F.concat_ws("\n\n", "tesseract_text", "htr_text"))
    rec = F.coalesce(norm_id("id"), "id").alias("rec_id")
    corpus = learn(docs.select(rec, whole.alias("text"), digital.alias("digital")).union(regions.select(rec, "htr_output", F.lit(False))))
    none = lambda c: F.lit(None).cast("string").alias(c)
    docs = docs.select(F.lit("documents").alias("tab"), rec, *_FIELDS[:3], none("htr_output"), digital.alias("digital"))
    regions = regions.select(F.lit("handwritten_regions").alias("tab"), rec, *map(none, _FIELDS[:3]), "htr_output", F.lit(False).alias("digital")).dropDuplicates(["rec_id", "htr_output"])
    return scan(docs.union(regions), _FIELDS, corpus, mend)


@LLM.add("p1_found")
def p1_found(spark, sf_dir):
    """Lines that are furniture, end in a broken word or hold misread characters."""
    return _scanned(spark, sf_dir, mend=False).distinct()


@LLM.add("p1_repaired")
def p1_repaired(spark, sf_dir):
    """Continuous readable paragraphs for every record and field."""
    return _scanned(spark, sf_dir, mend=True)
