"""Chunking of texts and exact top-k search by blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..session import stage

BLOCK = 8192
CHUNK_ROWS = 4096
BROADCAST_BYTES = 64 << 20


def chunks(docs: DataFrame, id_col: str, text_col: str, window: int = 256, step: int = 64, least: int = 10) -> DataFrame:
    """Sliding windows of words with at least ``least`` of them, numbered after the filter; short and null texts give none."""
    w = docs.select(F.col(id_col).alias("doc_id"), words(text_col).alias("w")).where(F.size("w") >= least)
    starts = F.sequence(F.lit(0), F.size("w") - 1, F.lit(step))
    parts = F.filter(F.transform(starts, lambda i: F.slice(F.col("w"), i + 1, F.lit(window))), lambda p: F.size(p) >= least)
    return w.select("doc_id", F.posexplode(parts).alias("chunk_index", "p")).select("doc_id", "chunk_index", F.size("p").alias("n_words"), F.concat_ws(" ", "p").alias("chunk_text"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles, without a Python object for a number."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((a @ b.T) / (na[:, None] * nb[None, :]))


class _Best:
    """The k best (id, score) of each query so far; equal scores, to twelve places, go to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        self.ids, self.scores = [np.empty(0, np.int64)] * len(queries), [np.empty(0)] * len(queries)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for r, s in enumerate(scores):
            i, s = np.concatenate([self.ids[r], ids]), np.concatenate([self.scores[r], s])
            near = np.round(s, 12)
            if len(s) > self.k:
                keep = np.flatnonzero(near >= np.partition(near, len(s) - self.k)[len(s) - self.k])
                i, s, near = i[keep], s[keep], near[keep]
            o = np.lexsort((i, -near))[: self.k]
            self.ids[r], self.scores[r] = i[o], s[o]

    def batch(self) -> pa.RecordBatch:
        n = [len(i) for i in self.ids]
        q = np.repeat(self.queries, n)
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(np.concatenate([*self.ids, np.empty(0, np.int64)]), pa.int64()), pa.array(np.concatenate([*self.scores, np.empty(0)]), pa.float64())], _HIT_NAMES)


_HIT_NAMES = ["query_id", "vec_id", "score"]
_HITS = "query_id bigint, vec_id bigint, score double"


def _packed(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows of up to ``rows`` vectors (i, v): ids and one flat array of doubles."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                p = b.slice(at, rows)
                flat = _matrix(p.column(1)).reshape(-1)
                one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
                yield pa.RecordBatch.from_arrays([one(p.column(0).to_numpy(zero_copy_only=False), pa.int64()), one(flat, pa.float64())], [f"{name}_ids", f"{name}_flat"])

    return df.mapInArrow(run, f"{name}_ids array<bigint>, {name}_flat array<double>")


def top_k(queries: DataFrame, vectors: DataFrame, id_col: str, vec_col: str, k: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``query_id, vec_id, score``: the k nearest vectors of each query by cosine, ties to the smaller id.

    Rows without id or vector are left out. Queries of up to ``broadcast_bytes`` are broadcast, so the vectors are scanned once where
    they lie and only each task's k best of a query are shuffled. More queries meet the vectors in blocks: a copy of the
    vectors for every ``BLOCK`` queries goes through the shuffle.
    """
    ok = lambda df: df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("i"), F.col(vec_col).alias("v"))
    q, v = stage(ok(queries)), ok(vectors)
    size = q.agg(F.coalesce(F.sum(8 * F.size("v") + 8), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        rows = q.toArrow()  # its size has just been checked
        ids = rows.column("i").to_numpy()
        asked = v.sparkSession.sparkContext.broadcast((ids, _matrix(rows.column("v").combine_chunks()) if len(ids) else None))

        def scan(batches):
            ids, a = asked.value
            best = _Best(ids, k)
            for b in batches:
                for at in range(0, b.num_rows if len(ids) else 0, CHUNK_ROWS):
                    p = b.slice(at, CHUNK_ROWS)
                    best.add(p.column(0).to_numpy(zero_copy_only=False), _cosines(a, _matrix(p.column(1))))
            yield best.batch()

        near = v.mapInArrow(scan, _HITS)
    else:
        blocks = stage(_packed(q, BLOCK, "q").withColumn("block", F.monotonically_increasing_id()))
        numbers = stage(blocks.select("block"))
        spread = _packed(v, CHUNK_ROWS, "v").crossJoin(numbers)

        def meet(batches):
            for b in batches:
                for r in range(b.num_rows):
                    qi, qf, vi, vf = (b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in ("q_ids", "q_flat", "v_ids", "v_flat"))
                    best = _Best(qi, k)
                    best.add(vi, _cosines(qf.reshape(len(qi), -1), vf.reshape(len(vi), -1)))
                    yield best.batch()

        near = blocks.join(spread, "block").select("q_ids", "q_flat", "v_ids", "v_flat").mapInArrow(meet, _HITS)
    w = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "vec_id")
    return near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def encoded(texts: DataFrame, id_col: str, text_col: str, encoder: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 256) -> DataFrame:
    """``id, embedding``: texts as vectors by any encoder.

    ``encoder`` makes, once in each task, a function from a list of texts to a matrix with a row for each; so a model is
    loaded by the workers and never pickled. Null texts are encoded as empty ones.
    """
    kind = dict(texts.dtypes)[id_col]

    def run(batches):
        encode = encoder()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                p = b.slice(at, batch)
                m = np.asarray(encode([t or "" for t in p.column(1).to_pylist()]), np.float32)
                ends = np.arange(len(m) + 1, dtype=np.int32) * (m.shape[1] if m.ndim == 2 else 0)
                yield pa.RecordBatch.from_arrays([p.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(m.reshape(-1)))], ["id", "embedding"])

    return texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, embedding array<float>")


def best_per_document(hits: DataFrame, document: Column, k: int) -> DataFrame:
    """The best hit of each document, then the k best documents; fewer where the hits share documents."""
    h = hits.withColumn("document", document)
    w = Window.partitionBy("query_id", "document").orderBy(F.round("score", 12).desc(), "vec_id")
    one = h.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    r = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "vec_id")
    return one.withColumn("rank", F.row_number().over(r)).where(F.col("rank") <= k)


def keep_latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Upsert by key: the last row of each key in the given order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
