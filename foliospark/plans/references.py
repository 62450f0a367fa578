"""p5: references to documents and pages that do not exist."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import id_hex, norm_id, sql_hex, sql_id
from ..functions.times import micros
from ..operators.references import orphan_references
from ..session import read_table
from .registry import CORE

_SQL = f"""
with docs as (select {sql_hex('id')} as k, bool_or(deleted_at is not null) as gone, min(uploaded_at) as came from documents where {sql_hex('id')} is not null group by 1),
pages as (select {sql_hex('id')} as k, min(created_at) as came from document_pages where {sql_hex('id')} is not null group by 1),
refs as (
  select 'document_pages' as tab, {sql_id('id')} as rec_id, {sql_hex('document_id')} as k, created_at as t, 'd' as kind from document_pages
  union all select 'search_feedback', {sql_id('id')}, {sql_hex('document_id')}, created_at, 'd' from search_feedback
  union all select 'handwritten_regions', {sql_id('id')}, {sql_hex('page_id')}, created_at, 'p' from handwritten_regions),
probed as (
  select distinct r.tab, r.rec_id, strftime(r.t, '%Y-%m') as month,
    case when r.kind = 'd' and d.k is null or r.kind = 'p' and p.k is null then 'missing'
         when r.kind = 'd' and d.gone then 'deleted'
         when coalesce(d.came, p.came) > r.t then 'late' end as reason
  from refs r left join docs d on r.kind = 'd' and r.k = d.k left join pages p on r.kind = 'p' and r.k = p.k
  where r.k is not null)
"""


def _orphans(spark, sf_dir):
    docs, pages, regions, feedback = (read_table(spark, sf_dir, t) for t in ("documents", "document_pages", "handwritten_regions", "search_feedback"))
    parents = docs.select(F.lit("d").alias("kind"), id_hex("id").alias("key"), F.col("deleted_at").isNotNull().alias("deleted"), micros("uploaded_at").alias("came_us"))
    parents = parents.unionByName(pages.select(F.lit("p").alias("kind"), id_hex("id").alias("key"), F.lit(False).alias("deleted"), micros("created_at").alias("came_us")))
    parts = [(pages, "document_pages", "document_id", "d"), (feedback, "search_feedback", "document_id", "d"), (regions, "handwritten_regions", "page_id", "p")]
    refs = None
    for df, tab, col, kind in parts:
        one = df.select(F.lit(tab).alias("tab"), norm_id("id").alias("rec_id"), F.lit(kind).alias("kind"), id_hex(col).alias("key"), micros("created_at").alias("ref_us"), F.date_format("created_at", "yyyy-MM").alias("month"))
        refs = one if refs is None else refs.unionByName(one)
    return orphan_references(refs, parents)


@CORE.add("p5_found", _SQL + "select distinct tab, rec_id, reason from probed where reason is not null")
def p5_found(spark, sf_dir):
    """References without a usable record and why."""
    return _orphans(spark, sf_dir).select("tab", "rec_id", "reason").distinct()


@CORE.add("p5_report", _SQL + "select tab, month, reason, count(*) as n_refs from probed where reason is not null group by 1, 2, 3")
def p5_report(spark, sf_dir):
    """Orphan references for each table and month of created_at."""
    return _orphans(spark, sf_dir).groupBy("tab", "month", "reason").agg(F.count("*").alias("n_refs"))
