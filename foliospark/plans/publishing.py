"""Queries on manifests, metadata and the dataset registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.order import numbered
from ..operators.search import keep_latest
from ..session import read_table
from .registry import CORE

_SPLIT = "case when lower(trim(split)) = 'val' then 'validation' else lower(trim(split)) end"


def _split():
    s = F.lower(F.trim("split"))
    return F.when(s == "val", "validation").otherwise(s)


@CORE.add("dataset_metadata", f"select source, {_SPLIT} as split, count(*) as n_rows, cast(ceil(count(*) / 500.0) as bigint) as n_shards from line_images group by 1, 2")
def dataset_metadata(spark, sf_dir):
    """Rows and shards of 500 for each source and split."""
    return read_table(spark, sf_dir, "line_images").groupBy("source", _split().alias("split")).agg(F.count("*").alias("n_rows"), F.ceil(F.count("*") / 500).alias("n_shards"))


@CORE.add(
    "dataset_lineage",
    "select r.name, r.version, r.s3_path, coalesce(c.n, 0) as n_images from (select *, row_number() over (partition by name order by downloaded_at desc nulls last, id desc) as rn from dataset_registry) r left join (select source, count(*) as n from line_images group by 1) c on c.source = r.name where rn = 1",
)
def dataset_lineage(spark, sf_dir):
    """The newest registered version of each dataset with its pictures."""
    r = keep_latest(read_table(spark, sf_dir, "dataset_registry"), "name", F.col("downloaded_at").desc_nulls_last(), F.col("id").desc())
    c = read_table(spark, sf_dir, "line_images").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"))
    return r.join(c, "name", "left").select("name", "version", "s3_path", F.coalesce("n", F.lit(0)).alias("n_images"))


@CORE.add(
    "numbered_rows",
    "select image_id, split, format('{}_{:06d}', split, rn - 1) as row_id from (select image_id, split, row_number() over (partition by split order by image_id) as rn from (select distinct image_id, " + _SPLIT + " as split from line_images))",
)
def numbered_rows(spark, sf_dir):
    """The running number of each picture within its split, in the order of ids.

    Numbers come from a range partition and the counts of the ranges before, so no split is ranked in one task.
    """
    i = read_table(spark, sf_dir, "line_images").select("image_id", _split().alias("split")).distinct()
    return numbered(i, ["split"], ["image_id"], "k").select("image_id", "split", F.format_string("%s_%06d", "split", F.col("k") - 1).alias("row_id"))


@CORE.add("seeded_sample", "select image_id from (select distinct image_id from line_images) order by md5('17:' || image_id), image_id limit 50")
def seeded_sample(spark, sf_dir):
    """A reproducible sample of 50 pictures by hash order."""
    return read_table(spark, sf_dir, "line_images").select("image_id").distinct().orderBy(F.md5(F.concat(F.lit("17:"), "image_id")), "image_id").limit(50)
