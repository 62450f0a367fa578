"""Splits that keep related records together: hash-to-min components, then weighted rendezvous hashing.

Clusters are held as rows (node, member), never as one gathered set, so a component with a third of all
records stays spread over the cluster. Minima are pre-aggregated before each shuffle.
"""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, stage

MAX_ROUNDS = 60
#: Share of all records above which a component is placed by itself.
STEP = 0.001


def hash_to_min(edges: DataFrame, a: str, b: str, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, component``: the smallest node of each connected component, for every node of ``edges``.

    Every node sends its cluster to the cluster's minimum and the minimum to the rest, until nothing changes.
    Rows with a null end tie nothing, but their other end is a node. An empty table gives none.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    alone = e.select(F.coalesce("x", "y").alias("x"), F.coalesce("y", "x").alias("y")).where("x is not null").distinct()
    nodes = alone.select(F.col("x").alias("node")).union(alone.select(F.col("y").alias("node"))).distinct()
    clusters = alone.select(F.col("x").alias("node"), F.col("y").alias("member")).union(alone.select(F.col("y").alias("node"), F.col("x").alias("member"))).union(nodes.select("node", F.col("node").alias("member"))).distinct()
    clusters, before = cut(clusters), None
    for _ in range(max_rounds):
        low = clusters.groupBy("node").agg(F.min("member").alias("low"))
        sent = clusters.join(low, "node")
        to_min = sent.select(F.col("low").alias("node"), "member")
        to_rest = sent.select(F.col("member").alias("node"), F.col("low").alias("member"))
        clusters = cut(to_min.union(to_rest).distinct())
        now = tuple(clusters.agg(F.count("*"), F.sum(F.xxhash64("node", "member").cast("decimal(38,0)"))).first())
        if now == before:
            return clusters.groupBy("node").agg(F.min("member").alias("component"))
        before = now
    raise RuntimeError(f"components were not stable after {max_rounds} rounds")


def rendezvous(components: DataFrame, component: str, weights: dict[str, float], seed: int = 17) -> DataFrame:
    """Adds ``split``: the split with the largest -w / ln(u), u a hash of component and split in (0, 1)."""
    scored = []
    for name, w in weights.items():
        u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(name), F.col(component)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
        scored.append(F.struct((-F.lit(float(w)) / F.log(u)).alias("score"), F.lit(name).alias("name")))
    return components.withColumn("split", F.greatest(*scored)["name"])


def grouped_split(records: DataFrame, component: str, weights: dict[str, float], stored: DataFrame | None = None, seed: int = 17) -> DataFrame:
    """``component, n_records, split`` with shares of the records close to ``weights``.

    One rule for all sizes: a component may go to the splits that still have room for it (all, where none has), and
    among these weighted rendezvous hashing by the room left decides. Components of more than ``STEP`` of the records,
    so at most 1 / STEP of them, are placed one after the other, the largest first; all others at once, since no one of
    these moves a share by more than STEP.

    ``stored`` (component, split) is an earlier assignment: its components keep their split, so a snapshot with
    more records moves none. A component with several earlier splits takes the one with most of its rows there.
    """
    sizes = records.groupBy(component).agg(F.count("*").alias("n_records"))
    if stored is None:
        sizes = sizes.withColumn("kept", F.lit(None).cast("string"))
    else:
        votes = stored.groupBy(F.col("component").alias(component), "split").agg(F.count("*").alias("k"))
        kept = votes.groupBy(component).agg(F.max(F.struct("k", "split"))["split"].alias("kept"))
        sizes = sizes.join(kept, component, "left")
    sizes = stage(sizes)
    scale, n = sum(weights.values()), F.col("n_records")
    total = sizes.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    room = {k: w / scale * total for k, w in weights.items()}
    for name, taken in sizes.where("kept is not null").groupBy("kept").agg(F.sum(n)).collect():  # a row a split
        room[name] = room.get(name, 0.0) - taken
    large = n > STEP * total
    placed: dict[str, str] = {}
    for c, m in sizes.where(large & F.col("kept").isNull()).orderBy(n.desc(), component).select(component, "n_records").collect():  # at most 1 / STEP rows
        fits = {k: v for k, v in room.items() if v >= m} or room
        placed[c] = max(fits, key=lambda k: (-max(1e-9, fits[k]) / math.log(_uniform(seed, k, c)), k))
        room[placed[c]] -= m
    out = rendezvous(sizes, component, {k: max(1e-9, v) for k, v in room.items()} if total else weights, seed)
    if placed:
        by_name = F.create_map(*(F.lit(x) for kv in placed.items() for x in kv))
        out = out.withColumn("split", F.when(large, F.coalesce(by_name[F.col(component)], F.col("split"))).otherwise(F.col("split")))
    return out.withColumn("split", F.coalesce("kept", "split")).drop("kept")


def _uniform(seed: int, split: str, component: str) -> float:
    """A hash of component and split in (0, 1)."""
    return (xxhash.xxh64_intdigest(f"{split}|{component}", seed) + 0.5) / 2.0**64


def tied_pairs(labels: DataFrame, a: str, b: str, rows: int = 2000) -> DataFrame:
    """All pairs a < b of the members of one component, of ``labels`` (component, doc).

    The left side of a component of n members is dealt to n / ``rows`` parts and the right side repeated for each, so
    the pairs of a large one come from many tasks.
    """
    parts = labels.groupBy("component").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts")).where("parts > 1")
    known = labels.join(parts, "component", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    left = known.select("component", F.col("doc").alias(a), F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"))
    right = known.select("component", F.col("doc").alias(b), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return left.join(right, ["component", "part"]).where(F.col(a) < F.col(b)).select(a, b)
