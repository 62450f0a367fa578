"""Encoding of a whole corpus by a public vocabulary, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import VOCABULARY, encoder, ship


def encode_texts(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids``: the ids of every text without special tokens; null and empty texts give an empty list.

    Texts of any length are encoded whole; repeated rows come out as often as they go in.
    """

    def run(batches):
        e = encoder(vocabulary)
        for b in batches:
            ids = e.encode_batch(b.column(1).to_pylist())
            ends = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=ends[1:])
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    ship(docs.sparkSession.sparkContext, vocabulary)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens`` only, for sizes; nothing else leaves the worker."""

    def run(batches):
        e = encoder(vocabulary)
        for b in batches:
            n = [len(x) for x in e.encode_batch(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], ["doc_id", "n_tokens"])

    ship(docs.sparkSession.sparkContext, vocabulary)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, n_tokens int")
