"""Same or near-same pictures across splits: winnowed fingerprints joined, chained, and extended by alignment.

Equal pictures form a class by content hash and are aligned once; pairs of classes become pairs of records only at
the end. Every fingerprint that pictures of both sides hold is a seed, however many hold it; those of very many are joined in parts.
Seeds on one diagonal (the same shift of columns, one more or less) are chained; a pair of classes is aligned on the pictures
themselves at every chain that has enough seeds and spans enough of the shorter line (a word that the same hand wrote twice spans
little), the best first, until one shows the same picture. No fingerprint, partner or candidate is capped.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .strokes import fingerprints, ink, similarity

SAME = 0.982
#: Share of the fewer fingerprints that a chain holds at least, and of the shorter line's length that it spans.
SHARE, SPAN = 0.06, 0.2
#: Seeds that one fingerprint may bring to a task; more are spread over parts.
HEAVY = 1_000_000
_FP = "cls string, hashes array<bigint>, places array<int>"
_BATCH = 256


def side_of(split) -> F.Column:
    """``train`` for train and train_augmented, ``eval`` for validation, val and test, in any spelling; else null."""
    s = F.lower(F.trim(split))
    return F.when(s.isin("train", "train_augmented"), "train").when(s.isin("validation", "val", "test"), "eval")


def _fingerprint_rows(batches):
    for b in batches:
        for i in range(0, b.num_rows, _BATCH):
            part = b.slice(i, _BATCH)
            inks = [ink(x) for x in part.column(1).to_pylist()]
            keep = [k for k, x in enumerate(inks) if x is not None]
            fps = fingerprints([inks[k] for k in keep])
            ends = np.zeros(len(keep) + 1, np.int32)
            np.cumsum([len(h) for h, _ in fps], out=ends[1:])
            h = np.concatenate([x for x, _ in fps]) if fps else np.empty(0, np.int64)
            at = np.concatenate([x for _, x in fps]) if fps else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(keep, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(h)), pa.ListArray.from_arrays(pa.array(ends), pa.array(at))],
                ["cls", "hashes", "places"],
            )


def _align_rows(batches, same: float):
    for b in batches:
        seen: dict[str, np.ndarray | None] = {}
        cols = {n: b.column(n).to_pylist() for n in ("eval_cls", "train_cls", "shifts", "coverages", "eval_png", "train_png")}
        coverage, score = [], []
        for e, t, shifts, shares, x, y in zip(*cols.values()):
            for k, png in ((e, x), (t, y)):
                if k not in seen:
                    seen[k] = ink(png)
            for dx, share in zip(shifts, shares):
                like = similarity(seen[e], seen[t], dx)
                if like >= same:
                    break
            coverage.append(share)
            score.append(like)
        yield pa.RecordBatch.from_arrays([b.column("eval_cls"), b.column("train_cls"), pa.array(coverage, pa.float64()), pa.array(score, pa.float64())], ["eval_cls", "train_cls", "coverage", "score"])


def _seeds(prints: DataFrame) -> DataFrame:
    """``ke, kt, shift, at_e, m, l``: every place where two pictures of different sides hold the same fingerprint.

    ``m`` is the lesser number of fingerprints of the two and ``l`` the lesser length they span.
    """
    n = F.size("hashes")
    base = prints.select("key", "in_train", "in_eval", n.alias("n"), F.when(n > 0, F.element_at("places", -1) - F.get("places", F.lit(0))).alias("l"), F.explode(F.arrays_zip("hashes", "places")).alias("f"))
    # both sizes travel as one number
    base = base.select("key", "in_train", "in_eval", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("l")).alias("nl"), F.col("f.hashes").alias("h"), F.col("f.places").alias("at"))
    seeds = F.col("e") * F.col("t")
    heavy = stage(base.groupBy("h").agg(F.sum("in_eval").alias("e"), F.sum("in_train").alias("t")).where(seeds > HEAVY).select("h", F.ceil(seeds / HEAVY).cast("int").alias("parts")))
    e, t, on = base.where("in_eval = 1"), base.where("in_train = 1"), ["h"]
    if not heavy.isEmpty():
        parts = F.coalesce("parts", F.lit(1))
        e = e.join(heavy, "h", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        t = t.join(heavy, "h", "left").withColumn("part", F.pmod(F.xxhash64("key", "at"), parts).cast("int"))
        on = ["h", "part"]
    e = e.select(*on, F.col("key").alias("ke"), F.col("at").alias("at_e"), F.col("nl").alias("nl_e"))
    t = t.select(*on, F.col("key").alias("kt"), F.col("at").alias("at_t"), F.col("nl").alias("nl_t"))
    least = lambda f: F.least(f("nl_e"), f("nl_t")).cast("int")
    return e.join(t, on).where("ke <> kt").select("ke", "kt", (F.col("at_e") - F.col("at_t")).alias("shift"), "at_e", least(lambda c: F.shiftright(c, 32)).alias("m"), least(lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))).alias("l"))


def _chains(prints: DataFrame) -> DataFrame:
    """``ke, kt, chains`` of ``prints`` (key, in_train, in_eval, hashes, places): the pairs with a chain that is enough, and all such chains.

    A chain: k (its seeds), span, z, shift, coverage; the best is the first.
    """
    # a pair's seeds meet once, and all that follows happens where they are
    seeds = _seeds(prints).repartition("ke", "kt")
    diagonals = seeds.groupBy("ke", "kt", "shift").agg(F.count("*").alias("k"), F.min("at_e").alias("first"), F.max("at_e").alias("last"), F.first("m").alias("m"), F.first("l").alias("l"))
    near = diagonals.withColumn("shift", F.explode(F.array(*(F.col("shift") + d for d in (-1, 0, 1)))))
    chained = near.groupBy("ke", "kt", "shift").agg(F.sum("k").alias("k"), (F.max("last") - F.min("first")).alias("span"), F.first("m").alias("m"), F.first("l").alias("l"))
    enough = (F.col("k") >= F.greatest(F.lit(1), F.floor(F.col("m") * SHARE))) & (F.col("span") >= F.floor(SPAN * F.col("l")))
    chain = F.struct("k", "span", (-F.abs("shift")).alias("z"), "shift", F.least(F.lit(1.0), F.col("k") / F.col("m")).alias("coverage"))
    return chained.where(enough).groupBy("ke", "kt").agg(F.sort_array(F.collect_list(chain), asc=False).alias("chains"))


def cross_split_pairs(images: DataFrame, same: float = SAME) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes that show the same picture, and the classes' members.

    ``images``: image_id, image_png, split, and whatever else. Missing, broken and blank pictures match nothing; rows
    without an id or with a split of no side are left out. Pairs: eval_cls, train_cls, coverage (the chained share of
    the smaller set of fingerprints), score. Members: cls, image_id, side, split, source, once each.
    """
    rows = images.withColumn("side", side_of(F.col("split"))).where("side is not null and image_id is not null and image_png is not null").withColumn("cls", F.md5("image_png"))
    members = rows.select("cls", "image_id", "side", "split", "source", "transcription").distinct()
    prints = rows.select("cls", "image_png").mapInArrow(_fingerprint_rows, _FP)
    # one row a class; which sides hold it goes along
    sides = members.groupBy("cls").agg(F.max((F.col("side") == "train").cast("int")).alias("in_train"), F.max((F.col("side") == "eval").cast("int")).alias("in_eval"))
    prints = stage(prints.groupBy("cls").agg(F.first("hashes").alias("hashes"), F.first("places").alias("places")).join(sides, "cls"))
    # seeds travel under a short key of the class; two classes under one key would only be aligned in vain
    prints = prints.withColumn("key", F.xxhash64("cls"))
    names = lambda k, cls: prints.select(F.col("key").alias(k), F.col("cls").alias(cls))
    found = stage(_chains(prints))  # few rows with a known size, so the pictures below are only shuffled where these are many
    found = found.join(names("ke", "eval_cls"), "ke").join(names("kt", "train_cls"), "kt").select("eval_cls", "train_cls", F.col("chains.shift").alias("shifts"), F.col("chains.coverage").alias("coverages"))
    found = stage(found)
    wanted = stage(found.select(F.col("eval_cls").alias("cls")).union(found.select(F.col("train_cls").alias("cls"))).distinct())
    pictures = rows.select("cls", "image_png").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("image_png").alias("png"))
    pictures = stage(pictures)
    both = found.join(pictures.select(F.col("cls").alias("eval_cls"), F.col("png").alias("eval_png")), "eval_cls").join(pictures.select(F.col("cls").alias("train_cls"), F.col("png").alias("train_png")), "train_cls")
    aligned = both.select("eval_cls", "train_cls", "shifts", "coverages", "eval_png", "train_png").mapInArrow(partial(_align_rows, same=same), "eval_cls string, train_cls string, coverage double, score double").where(F.col("score") >= same)
    exact = prints.where("in_train = 1 and in_eval = 1").select(F.col("cls").alias("eval_cls"), F.col("cls").alias("train_cls"), F.lit(1.0).alias("coverage"), F.lit(1.0).alias("score"))
    return aligned.union(exact), members


def record_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs of records behind pairs of classes, and whether their transcriptions agree; a missing one agrees with none."""
    e = members.where("side = 'eval'").select(F.col("cls").alias("eval_cls"), F.col("image_id").alias("eval_id"), F.col("split").alias("eval_split"), F.col("source").alias("eval_source"), F.col("transcription").alias("eval_text"))
    t = members.where("side = 'train'").select(F.col("cls").alias("train_cls"), F.col("image_id").alias("train_id"), F.col("source").alias("train_source"), F.col("transcription").alias("train_text"))
    same = F.coalesce(F.lower(F.trim("eval_text")) == F.lower(F.trim("train_text")), F.lit(False)).alias("same_text")
    return pairs.join(e, "eval_cls").join(t, "train_cls").where("eval_id <> train_id").select("eval_id", "train_id", "eval_split", "eval_source", "train_source", "coverage", "score", same)
