"""p7: train, validation and test for corrections tied by document or region."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import id_hex, norm_id, sql_id
from ..session import read_table
from .components import grouped_split, hash_to_min, tied_pairs
from .queries import LLM

WEIGHTS = {"train": 0.8, "validation": 0.1, "test": 0.1}
_SQL = f"""
with recursive c as (select distinct {sql_id('document_id')} as d, {sql_id('region_id')} as r from corrections),
link as (select distinct a.d as x, b.d as y from c a join c b on a.r = b.r and a.d <> b.d),
reach as (select x, y from link union select reach.x, link.y from reach join link on reach.y = link.x)
select x as document_a, y as document_b from reach where x < y
"""


def _ties(spark, sf_dir):
    c = read_table(spark, sf_dir, "corrections")
    return c.select("correction_id", F.concat(F.lit("d"), id_hex("document_id")).alias("d"), F.concat(F.lit("r"), id_hex("region_id")).alias("r"))


@LLM.add("p7_found", _SQL)
def p7_found(spark, sf_dir):
    """All pairs of different documents that must share a split."""
    labels = hash_to_min(_ties(spark, sf_dir), "d", "r").where("node like 'd%'").select("component", norm_id(F.substring("node", 2, 32)).alias("doc"))
    return tied_pairs(labels, "document_a", "document_b")


@LLM.add("p7_splits")
def p7_splits(spark, sf_dir):
    """The split of each record; records without any id stand alone. No earlier assignment is stored here."""
    ties = _ties(spark, sf_dir)
    labels = hash_to_min(ties, "d", "r")
    node = F.coalesce("d", "r", F.concat(F.lit("c"), F.coalesce("correction_id", F.lit(""))))
    own = ties.select("correction_id", node.alias("node")).join(labels, "node", "left").select("correction_id", F.coalesce("component", "node").alias("component"))
    return own.join(grouped_split(own, "component", WEIGHTS), "component").select("correction_id", "component", "split")
