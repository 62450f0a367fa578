"""Queries on pictures and ink profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import images as op
from ..session import read_table
from .registry import CORE


def _images(spark, sf_dir):
    return read_table(spark, sf_dir, "line_images")


@CORE.add("png_roundtrip")
def png_roundtrip(spark, sf_dir):
    """I01 I02 I03 Q-I3: how many pictures decode and come back equal after encoding."""
    s = op.picture_stats(_images(spark, sf_dir), "image_id", "image_png")
    n = lambda c: F.sum(F.coalesce(F.col(c), F.lit(False)).cast("bigint"))
    return s.agg(F.count("*").alias("n"), n("decodes").alias("n_decode"), n("round_trip").alias("n_round_trip"))


@CORE.add("image_stats")
def image_stats(spark, sf_dir):
    """I10 A14 Q-BLANK: statistics and hash of every picture."""
    return op.picture_stats(_images(spark, sf_dir), "image_id", "image_png").drop("round_trip")


@CORE.add("augmentation_report")
def augmentation_report(spark, sf_dir):
    """Q-BLANK Q-BLANKGATE Q-DUP Q-DRIFT J06 A05 A06: blank and duplicate shares and mean statistics of each split, and whether they pass.

    An augmented split also has its drift from the one it was made of, null where there is none; val counts as validation.
    """
    return split_report(_images(spark, sf_dir))


def split_report(images):
    i = images.select("image_id", "image_png", F.regexp_replace(F.lower(F.trim("split")), "^val(?=_|$)", "validation").alias("split"))
    keyed = i.select(F.concat_ws("|", "split", "image_id").alias("k"), "image_png")
    s = op.picture_stats(keyed, "k", "image_png").where("decodes").withColumn("split", F.split("image_id", r"\|")[0])
    per = s.groupBy("split", "average_hash").agg(F.count("*").alias("k"), F.sum(F.col("is_blank").cast("bigint")).alias("b"), F.sum("mean").alias("m"), F.sum("std").alias("d"))
    r = per.groupBy("split").agg(F.sum("k").alias("n"), (F.sum("b") / F.sum("k")).alias("blank_ratio"), (F.sum(F.col("k") - 1) / F.sum("k")).alias("dup_ratio"), F.round(F.sum("m") / F.sum("k"), 2).alias("mean"), F.round(F.sum("d") / F.sum("k"), 2).alias("std"))
    base = r.select(F.concat("split", F.lit("_augmented")).alias("split"), F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    r = r.join(base, "split", "left").withColumn("mean_drift", F.round(F.abs(F.col("mean") - F.col("base_mean")), 2)).withColumn("std_drift", F.round(F.abs(F.col("std") - F.col("base_std")), 2))
    drifts = F.abs(F.col("mean") - F.col("base_mean")) / 255 > 0.15
    return r.withColumn("passed", (F.col("blank_ratio") <= 0.95) & (F.col("dup_ratio") <= 0.05) & ~F.coalesce(drifts, F.lit(False))).drop("base_mean", "base_std")


@CORE.add("region_features")
def region_features(spark, sf_dir):
    """Written regions of each picture and their features."""
    return op.region_features(_images(spark, sf_dir), "image_id", "image_png")


@CORE.add("augment_expand")
def augment_expand(spark, sf_dir):
    """Three changed copies of each picture of train, validation and test; val counts as validation.

    Of several rows with one id the least by picture, text and split is taken.
    """
    split = F.regexp_replace(F.lower(F.trim("split")), "^val$", "validation").alias("split")
    i = _images(spark, sf_dir).select("image_id", "image_png", "transcription", split).where("split in ('train', 'validation', 'test')")
    one = i.groupBy("image_id").agg(F.min(F.struct("image_png", "transcription", "split")).alias("r")).select("image_id", "r.*")
    return op.augmented(one)


@CORE.add("drift_features")
def drift_features(spark, sf_dir):
    """Grid features of every picture as a drift reference."""
    return op.drift_features(_images(spark, sf_dir), "image_id", "image_png")


@CORE.add(
    "ink_regions",
    """with l as (select doc_id, unnest(string_split(merged_text, chr(10))) as line, generate_subscripts(string_split(merged_text, chr(10)), 1) - 1 as y from documents where merged_text is not null),
    s as (select doc_id, y, length(line) as ink, case when length(line) > 40 then 1 when length(line) <= 20 then 0 end as mark from l),
    t as (select *, coalesce(last_value(mark ignore nulls) over (partition by doc_id order by y rows unbounded preceding), 0) as inside from s),
    b as (select *, case when inside = 1 and coalesce(lag(inside) over (partition by doc_id order by y), 0) = 0 then 1 else 0 end as opens from t),
    g as (select *, sum(opens) over (partition by doc_id order by y rows unbounded preceding) as region from b where true)
    select doc_id, cast(region - 1 as bigint) as region_index, min(y) as y0, max(y) + 1 as y1, cast(sum(ink) as bigint) as ink from g where inside = 1 group by doc_id, region having count(*) >= 3""",
)
def ink_regions(spark, sf_dir):
    """The hysteresis of line detection in SQL, on the lengths of text lines as an ink profile."""
    d = read_table(spark, sf_dir, "documents").where("merged_text is not null")
    s = d.select("doc_id", F.posexplode(F.split("merged_text", "\n", -1)).alias("y", "line")).select("doc_id", F.col("y").cast("bigint").alias("y"), F.length("line").cast("bigint").alias("ink"))
    w = Window.partitionBy("doc_id").orderBy("y")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("ink") > 40, 1).when(F.col("ink") <= 20, 0)
    t = s.withColumn("inside", F.coalesce(F.last(mark, ignorenulls=True).over(so_far), F.lit(0)))
    t = t.withColumn("opens", ((F.col("inside") == 1) & (F.coalesce(F.lag("inside").over(w), F.lit(0)) == 0)).cast("bigint")).withColumn("region", F.sum("opens").over(so_far))
    g = t.where("inside = 1").groupBy("doc_id", "region").agg(F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.sum("ink").alias("ink"), F.count("*").alias("k")).where("k >= 3")
    return g.select("doc_id", (F.col("region") - 1).alias("region_index"), "y0", "y1", "ink")
