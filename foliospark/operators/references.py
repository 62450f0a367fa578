"""References to records that do not exist, by binary search in range-partitioned key arrays.

Parents are cut into ranges of about ``range_keys`` keys, each stored as one sorted array; references are
probed in vectorised batches against the array of their range. The ranges are of the keys' hashes, so they are even
whatever the ids look like and need no cut points. A range that holds more references than ``probe_rows`` (a popular
key may hold a third of all) is spread over several probes by salt, with the range's parents repeated for each; so no
task gathers more than a bounded number of rows, and nothing that grows with the data is broadcast by hand or comes to
the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

RANGE_KEYS = 100_000
PROBE_ROWS = 200_000
_FAR = np.iinfo(np.int64).max


def _range(n: int) -> Column:
    """The place of a key's hash among ``n`` equal ranges."""
    return F.floor(F.shiftrightunsigned(F.xxhash64("kind", "key"), 11) / F.lit(float(1 << 53)) * n).cast("int")


def _probe(key, refs: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    out = refs[["tab", "rec_id", "month"]].copy()
    keys = parents["kind_key"].to_numpy(dtype="S36")
    order = np.argsort(keys, kind="stable")
    keys, gone, came = keys[order], parents["gone"].to_numpy(dtype=bool)[order], parents["came_us"].to_numpy(dtype=np.int64)[order]
    want = refs["kind_key"].to_numpy(dtype="S36")
    at = np.searchsorted(keys, want)
    inside = np.minimum(at, max(len(keys) - 1, 0))
    hit = keys[inside] == want if len(keys) else np.zeros(len(want), bool)
    seen = refs["ref_us"].to_numpy(dtype=np.int64)
    reason = np.full(len(want), "", dtype=object)
    reason[~hit] = "missing"
    if len(keys):
        deleted = hit & gone[inside]
        reason[deleted] = "deleted"
        reason[hit & ~deleted & (came[inside] > seen)] = "late"
    out["reason"] = reason
    return out[out["reason"] != ""]


def orphan_references(refs: DataFrame, parents: DataFrame, range_keys: int = RANGE_KEYS, probe_rows: int = PROBE_ROWS) -> DataFrame:
    """``tab, rec_id, month, reason`` of each reference without a usable record.

    ``refs``: tab, rec_id, kind (which parent table), key (32 digits), ref_us, month; a null key refers to
    nothing and is left out. ``parents``: kind, key, deleted, came_us; of several rows with one key the
    earliest arrival counts, and the key is deleted if any row is. A null ref_us or came_us is never late.
    reason is missing, else deleted, else late. Repeated references come out once.
    """
    far = F.lit(int(_FAR))
    named = refs.where("key is not null")
    # a bound from the tables' row counts, which Parquet knows without reading rows
    n = max(1, math.ceil(parents.count() / range_keys), math.ceil(refs.count() / probe_rows))
    kind_key = F.concat("kind", "key").alias("kind_key")
    # staged, so its size is known when Spark decides between a broadcast and a shuffle of both sides
    sizes = named.groupBy(_range(n).alias("rng")).agg(F.ceil(F.count("*") / probe_rows).cast("int").alias("salts"))
    sizes = stage(sizes)
    left = named.withColumn("rng", _range(n)).join(sizes, "rng")
    left = left.select("rng", F.pmod(F.xxhash64("tab", "rec_id"), F.col("salts")).cast("int").alias("salt"), "tab", "rec_id", "month", F.coalesce("ref_us", far).alias("ref_us"), kind_key)
    p = parents.where("key is not null").groupBy("kind", "key").agg(F.max(F.coalesce("deleted", F.lit(False))).alias("gone"), F.coalesce(F.min("came_us"), F.lit(0)).alias("came_us"))
    right = p.withColumn("rng", _range(n)).join(sizes, "rng").select("rng", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), kind_key, "gone", "came_us")
    found = left.groupBy("rng", "salt").cogroup(right.groupBy("rng", "salt")).applyInPandas(lambda k, a, b: _probe(k, a, b), "tab string, rec_id string, month string, reason string")
    return found.dropDuplicates(["tab", "rec_id", "reason", "month"])
