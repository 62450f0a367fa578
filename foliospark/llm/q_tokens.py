"""p8: documents.text as ids of byte_bpe_50k."""

from __future__ import annotations

from ..session import read_table
from .queries import LLM
from .tokens import encode_texts


@LLM.add("p8_ids")
def p8_ids(spark, sf_dir):
    """The token ids of each document."""
    return encode_texts(read_table(spark, sf_dir, "documents"), "doc_id", "text")
