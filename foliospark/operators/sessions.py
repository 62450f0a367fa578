"""Grouping activity into sessions by pairing starts with ends.

Skew: one user may hold a third of all events. No user is ever gathered in one task: a user's time is
cut into slabs, each slab window also sees the events within one gap of its borders, and the ranks of
starts and ends become global by adding what earlier slabs of the user counted. Only the per-slab
totals (bounded by the time span, not by the rows) are summed up along a user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

GAP_US = 30 * 60 * 1_000_000
SLAB_US = 6 * 3600 * 1_000_000


def distinct_events(events: DataFrame, id_col: str, user_col: str, us_col: str) -> DataFrame:
    """``user_id, us, n``: the number of events of each user at each time; rows with the same id count once.

    Events without an id count each; without a user or a time they belong to no session and are left out.
    """
    e = events.select(F.col(id_col).alias("id"), F.col(user_col).alias("user_id"), F.col(us_col).alias("us"))
    e = e.where(F.col("user_id").isNotNull() & F.col("us").isNotNull())
    key = F.coalesce(F.col("id"), F.concat_ws("|", F.lit("-"), "user_id", F.col("us").cast("string")))
    once = e.groupBy(key.alias("k")).agg(F.min(F.struct("us", "user_id")).alias("e"), F.when(F.max("id").isNull(), F.count("*")).otherwise(F.lit(1)).alias("n"))
    return once.groupBy(F.col("e.user_id").alias("user_id"), F.col("e.us").alias("us")).agg(F.sum("n").cast("bigint").alias("n"))


def marked_events(times: DataFrame, gap_us: int = GAP_US, slab_us: int = SLAB_US) -> DataFrame:
    """Every (user, time) with whether it starts or ends a session and its global session number and running count."""
    if slab_us < gap_us:
        raise ValueError("a slab must be at least as long as the gap")
    own = F.floor(F.col("us") / F.lit(slab_us)).cast("bigint")
    off = F.col("us") - F.col("own") * slab_us
    copies = F.array_compact(F.array(F.col("own"), F.when(off <= gap_us, F.col("own") - 1), F.when(F.lit(slab_us) - off <= gap_us, F.col("own") + 1)))
    spread = times.withColumn("own", own).withColumn("slab", F.explode(copies))
    mine = F.col("slab") == F.col("own")
    part = Window.partitionBy("user_id", "slab")
    before = part.orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    after = part.orderBy(-F.col("us")).rangeBetween(Window.unboundedPreceding, -1)
    near = spread.withColumn("prev", F.max("us").over(before)).withColumn("next", F.min("us").over(after)).where(mine)
    flags = near.select(
        "user_id", "us", "n", "slab",
        (F.col("prev").isNull() | (F.col("us") - F.col("prev") > gap_us)).cast("bigint").alias("is_start"),
        (F.col("next").isNull() | (F.col("next") - F.col("us") > gap_us)).cast("bigint").alias("is_end"),
    )
    totals = flags.groupBy("user_id", "slab").agg(F.sum("n").alias("tn"), F.sum("is_start").alias("ts"), F.sum("is_end").alias("te"))
    earlier = Window.partitionBy("user_id").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("user_id", "slab", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("tn", "ts", "te")))
    running = part.orderBy("us").rowsBetween(Window.unboundedPreceding, 0)
    local = flags.select("*", F.sum("n").over(running).alias("cn"), F.sum("is_start").over(running).alias("cs"), F.sum("is_end").over(running).alias("ce"))
    return local.join(offsets, ["user_id", "slab"]).select(
        "user_id", "us", "n", "is_start", "is_end",
        (F.col("tn") + F.col("cn")).alias("seen"), (F.col("ts") + F.col("cs")).alias("start_rank"), (F.col("te") + F.col("ce")).alias("end_rank"),
    )


def sessions(times: DataFrame, gap_us: int = GAP_US, slab_us: int = SLAB_US) -> DataFrame:
    """``user_id, session_no, start_us, end_us, n_events``: starts and ends of equal rank joined, counts by rank difference.

    A gap of exactly ``gap_us`` does not part. Equal times belong to one session. An empty table gives none.
    """
    # only starts and ends go on; written once, for both are read from it
    m = stage(marked_events(times, gap_us, slab_us).where("is_start = 1 or is_end = 1"))
    starts = m.where("is_start = 1").select("user_id", F.col("start_rank").alias("session_no"), F.col("us").alias("start_us"), (F.col("seen") - F.col("n")).alias("before"))
    ends = m.where("is_end = 1").select("user_id", F.col("end_rank").alias("session_no"), F.col("us").alias("end_us"), F.col("seen").alias("upto"))
    return starts.join(ends, ["user_id", "session_no"]).select("user_id", "session_no", "start_us", "end_us", (F.col("upto") - F.col("before")).alias("n_events"))
