"""The correction archive to a training set: eligibility, newest per region, split by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bucket_10000, strip

SALTS = 16


def eligible(corrections: DataFrame, docs: DataFrame) -> DataFrame:
    """Corrections that users opted in, with a text, of documents uploaded by users and not deleted; missing opt-in is none."""
    ok = docs.where("source = 'user_upload' and deleted_at is null").select(F.col("id").alias("document_id"))
    return corrections.where(F.coalesce("opted_in", F.lit(False)) & (strip(F.coalesce("corrected_text", F.lit(""))) != "")).join(ok, "document_id", "left_semi")


def newest_per_region(rows: DataFrame) -> DataFrame:
    """The newest row of each region by ``at`` (null is oldest), ties to the smaller correction_id; rows without a region are left out.

    A region may hold a third of all rows, so each is ranked in ``SALTS`` parts before the parts' winners are.
    """
    order = [F.col("at").desc_nulls_last(), F.col("correction_id"), F.col("corrected_text"), F.col("crop_s3_url")]
    part = rows.where("region_id is not null").withColumn("salt", F.pmod(F.xxhash64("correction_id"), F.lit(SALTS)))
    part = part.withColumn("rn", F.row_number().over(Window.partitionBy("region_id", "salt").orderBy(*order))).where("rn = 1").drop("salt")
    return part.withColumn("rn", F.row_number().over(Window.partitionBy("region_id").orderBy(*order))).where("rn = 1").drop("rn")


def document_split(rows: DataFrame, column: str = "document_id", val_share: int = 2000) -> DataFrame:
    """``split`` by int(sha256(document)) % 10000 < val_share; bucket 2000 itself is train."""
    return rows.withColumn("split", F.when(bucket_10000(F.col(column)) < val_share, "val").otherwise("train"))


def as_of(events: DataFrame, versions: DataFrame, key: str, event_at: str, version_at: str, value: str, hot_rows: int = 100_000) -> DataFrame:
    """Each event with the value of the newest version at or before it, null before the first.

    Versions and events of a key are merged in time order and the last version carried on. A key with more than
    ``hot_rows`` events has them dealt to so many parts that none holds more, each with all of the key's versions.
    """
    keep = [c for c in events.columns if c != key]
    named = events.where(F.col(key).isNotNull())
    hot = named.groupBy(key).agg(F.ceil(F.count("*") / hot_rows).cast("int").alias("_parts")).where("_parts > 1")
    parts = F.coalesce("_parts", F.lit(1))
    v = versions.where(F.col(key).isNotNull() & F.col(version_at).isNotNull()).join(hot, key, "left")
    v = v.select(F.col(key), F.col(version_at).alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(value).alias("x")).alias("_v"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt"), F.lit(None).alias("_e"))
    e = named.join(hot, key, "left").select(F.col(key), F.col(event_at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.pmod(F.xxhash64(*keep), parts).cast("int").alias("_salt"), F.struct(*keep).alias("_e"))
    v = v.withColumn("_e", F.lit(None).cast(e.schema["_e"].dataType))
    w = Window.partitionBy(key, "_salt").orderBy("_at", "_kind", F.col("_v.x")).rowsBetween(Window.unboundedPreceding, 0)
    merged = v.unionByName(e).withColumn("_last", F.last("_v", ignorenulls=True).over(w)).where("_kind = 1")
    return merged.select(key, "_e.*", F.col("_last.x").alias(value))
