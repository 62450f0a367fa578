"""p3: documents longer than 2,000 characters in pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read_table
from .chunking import split_texts
from .queries import LLM

_SQL = r"""
select doc_id, cast(max(length(w)) > 2000 as int) as hard_cut
from (select doc_id, unnest(regexp_split_to_array(merged_text, '[\s\pZ\x0b\x1c-\x1f\x85]+')) as w from documents where length(merged_text) > 2000)
group by doc_id
"""


@LLM.add("p3_found", _SQL)
def p3_found(spark, sf_dir):
    """The documents that had to be cut, and whether a cut had to go through a word."""
    p = split_texts(read_table(spark, sf_dir, "documents"), "doc_id", "merged_text").drop("piece")
    return p.groupBy("doc_id").agg(F.max(F.col("hard").cast("int")).alias("hard_cut"))


@LLM.add("p3_pieces")
def p3_pieces(spark, sf_dir):
    """Every piece with its place in the text and how much of it repeats the piece before."""
    return split_texts(read_table(spark, sf_dir, "documents"), "doc_id", "merged_text")
