"""Row rules for corrections, first match wins, and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

MAX_CHARS = 2000


def reason(with_listing: bool = False) -> Column:
    """The rule a correction breaks, null if none: R2 empty, R5 too long, R1 nothing changed, R3 bad address, R4 no object.

    Columns: corrected_text, original_text, crop_s3_url and, with a listing, object_exists. Null texts count as empty;
    length is that of the text as typed; R1 needs an original; an address without a key breaks R3 only with a listing.
    """
    text, orig = F.coalesce("corrected_text", F.lit("")), F.coalesce("original_text", F.lit(""))
    c, o, url = F.lower(strip(text)), F.lower(strip(orig)), F.coalesce("crop_s3_url", F.lit(""))
    r = F.when(c == "", "R2").when(F.length(text) > MAX_CHARS, "R5").when((o != "") & (o == c), "R1").when(~url.startswith("s3://"), "R3")
    if with_listing:
        r = r.when(~url.rlike("^s3://[^/]*/"), "R3").when(~F.coalesce("object_exists", F.lit(False)), "R4")
    return r


def report(rows: DataFrame, order: str, samples: int = 5, chars: int = 80) -> DataFrame:
    """``reason, n, samples``: how many rows broke each rule and the first of them, texts cut to ``chars``."""
    bad = rows.where("reason is not null")
    w = Window.partitionBy("reason").orderBy(order)
    # the few first rows of each of five rules; the limit is the report's own
    first = bad.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= samples)
    lists = first.groupBy("reason").agg(F.transform(F.sort_array(F.collect_list(F.struct("rn", F.substring(F.coalesce("corrected_text", F.lit("")), 1, chars).alias("t")))), lambda x: x["t"]).alias("samples"))
    return bad.groupBy("reason").agg(F.count("*").alias("n")).join(lists, "reason")
