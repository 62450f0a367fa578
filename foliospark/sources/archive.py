"""Reading shards and archives, writing snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.search import keep_latest

ARCHIVE = "correction_id string, region_id string, document_id string, corrected_text string, original_text string, corrected_at string, user_id string, crop_s3_url string, opted_in boolean"


def read_shards(spark: SparkSession, base: str, split: str | None = None) -> DataFrame:
    """All Parquet shards below a folder, or those directly in one split's folder."""
    if split is None:
        return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(base)
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{base}/{split}")


def read_archive(spark: SparkSession, base: str, lines: bool = False) -> DataFrame:
    """Archived corrections under ``date=`` folders, one JSON object a file or, with ``lines``, one a line; broken ones are left out, absent fields are null."""
    raw = spark.read.schema(f"{ARCHIVE}, date string, _corrupt_record string").option("multiLine", str(not lines).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(base)
    return raw.where("_corrupt_record is null").drop("_corrupt_record")


def read_database(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a relational database by JDBC, where a driver is on the class path; read-only."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, sessionInitStatement="SET default_transaction_read_only = on", **options).load()


def write_snapshot(rows: DataFrame, base: str, version: str, split_col: str = "split", shard_rows: int = 500, one_file_at_a_time: bool = False) -> dict:
    """Writes ``{base}/{version}/{split}=.../`` in shards of at most ``shard_rows`` rows and a manifest beside; returns the manifest.

    Rows are clustered by split so that shards are full; the splits' counts come from the written files.
    """
    path = f"{base}/{version}"
    out = rows.coalesce(1) if one_file_at_a_time else rows
    out.write.mode("overwrite").option("maxRecordsPerFile", shard_rows).partitionBy(split_col).parquet(f"{path}/data")
    spark = rows.sparkSession
    back = spark.read.parquet(f"{path}/data").withColumn("_file", F.input_file_name())
    per = back.groupBy(split_col).agg(F.count("*").alias("rows"), F.countDistinct("_file").alias("shards"))
    manifest = {"version": version, "splits": {str(r[split_col]): {"rows": r["rows"], "shards": r["shards"]} for r in per.collect()}, "columns": rows.columns}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def ensure_table(spark: SparkSession, name: str, schema: str, location: str | None = None) -> bool:
    """Creates an empty Parquet table unless there is one; whether it was created. An existing table keeps its rows."""
    if spark.catalog.tableExists(name):
        return False
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING PARQUET" + (f" LOCATION '{location}'" if location else ""))
    return True


def register_dataset(registry: DataFrame, entry: DataFrame) -> DataFrame:
    """The registry with an entry added; of several rows with one name the newest stays."""
    return keep_latest(registry.unionByName(entry, allowMissingColumns=True), "name", F.col("downloaded_at").desc_nulls_last(), F.col("id").desc())
