"""Queries on chunking, vector search and its fallbacks. Documents of the vector table: vec_id div 5; label 9 marks deleted ones."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.ids import norm_id, sql_id
from ..functions.text import uuid5_dns
from ..operators import search as op
from ..session import read_table
from .registry import CORE
from .views import CORR, corrections

KEYWORD_HITS = 20
_CHUNKS = r"""w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x0b\x1c-\x1f\x85\pZ]+'), lambda x: x <> '') as w from documents),
c as (select doc_id, w[i + 1 : i + 256] as p, i from (select doc_id, w, unnest(range(0, len(w), 64)) as i from w where len(w) >= 10)),
chunks as (select doc_id, cast(row_number() over (partition by doc_id order by i) - 1 as int) as chunk_index, cast(len(p) as int) as n_words, array_to_string(p, ' ') as chunk_text from c where len(p) >= 10)"""


def _chunks(spark, sf_dir):
    return op.chunks(read_table(spark, sf_dir, "documents"), "doc_id", "text")


@CORE.add("text_chunks", f"with {_CHUNKS} select * from chunks")
def text_chunks(spark, sf_dir):
    """Overlapping windows of words."""
    return _chunks(spark, sf_dir)


@CORE.add(
    "chunk_point_ids",
    f"""with {_CHUNKS} select doc_id, chunk_index, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || substr('89ab', cast(cast('0x' || substr(d, 17, 1) as bigint) % 4 + 1 as int), 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) as point_id
    from (select doc_id, chunk_index, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(doc_id || '_' || chunk_index)) as d from chunks)""",
)
def chunk_point_ids(spark, sf_dir):
    """Stable point ids of chunks."""
    return _chunks(spark, sf_dir).select("doc_id", "chunk_index", uuid5_dns(F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"))).alias("point_id"))


_TOP = """v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e, label from embeddings),
scored as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) as score from v q, v where q.vec_id % 50 = 0 and v.label <> 9),
ten as (select * from (select *, row_number() over (partition by query_id order by round(score, 12) desc, vec_id) as rn from scored) where rn <= 10),
one as (select * from (select *, vec_id // 5 as document, row_number() over (partition by query_id, vec_id // 5 order by round(score, 12) desc, vec_id) as k from ten) where k = 1),
five as (select query_id, vec_id, document, round(score, 6) as score, cast(rank as int) as rank from (select *, row_number() over (partition by query_id order by round(score, 12) desc, vec_id) as rank from one) where rank <= 5)"""


def _top(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    hits = op.top_k(e.where("vec_id % 50 = 0"), e.where("label <> 9"), "vec_id", "embedding", 10)
    return op.best_per_document(hits, F.expr("vec_id div 5"), 5).select("query_id", "vec_id", "document", F.round("score", 6).alias("score"), "rank")


@CORE.add("topk_search", f"with {_TOP} select * from five")
def topk_search(spark, sf_dir):
    """The five best documents among the ten nearest chunks, for every query."""
    return _top(spark, sf_dir)


@CORE.add("keyword_fallback", f"with {_TOP} select query_id, round(coalesce(max(score), 0), 4) as best, coalesce(max(score), 0) < 0.4 as fallback from five group by 1")
def keyword_fallback(spark, sf_dir):
    """Queries whose best score is too low for semantic search alone."""
    return _top(spark, sf_dir).groupBy("query_id").agg(F.round(F.coalesce(F.max("score"), F.lit(0.0)), 4).alias("best"), (F.coalesce(F.max("score"), F.lit(0.0)) < 0.4).alias("fallback"))


@CORE.add(
    "hybrid_hits",
    f"""with {_TOP}, per as (select *, row_number() over (partition by label order by n_keyword desc, document) as rn from (select label, vec_id // 5 as document, count(*) as n_keyword from embeddings where label <> 9 group by 1, 2)),
    kw as (select q.vec_id as query_id, per.document, per.n_keyword from embeddings q join per on q.label = per.label and per.rn <= 20 where q.vec_id % 50 = 0) select coalesce(f.query_id, k.query_id) as query_id, coalesce(f.document, k.document) as document, f.score as semantic, coalesce(k.n_keyword, 0) as n_keyword from five f full join kw k on f.query_id = k.query_id and f.document = k.document""",
)
def hybrid_hits(spark, sf_dir):
    """Semantic hits and the twenty documents with the most hits by label in one list, each document once for each query."""
    e = read_table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label")
    per = e.where("label <> 9").groupBy("label", F.expr("vec_id div 5").alias("document")).agg(F.count("*").alias("n_keyword"))
    w = Window.partitionBy("label").orderBy(F.col("n_keyword").desc(), "document")
    per = per.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= KEYWORD_HITS).drop("rn")  # before the join, so no query meets all of its label
    kw = q.join(per, "label").select("query_id", "document", "n_keyword")
    return _top(spark, sf_dir).select("query_id", "document", F.col("score").alias("semantic")).join(kw, ["query_id", "document"], "full").select("query_id", "document", "semantic", F.coalesce("n_keyword", F.lit(0)).alias("n_keyword"))


@CORE.add(
    "latest_points",
    "select doc, vec_id, label from (select vec_id // 5 as doc, vec_id, label, row_number() over (partition by vec_id // 5 order by vec_id desc) as rn from embeddings) where rn = 1",
)
def latest_points(spark, sf_dir):
    """The last version of each point after an upsert."""
    e = read_table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 5").alias("doc"), "vec_id", "label")
    return op.keep_latest(e, "doc", F.col("vec_id").desc())


@CORE.add(
    "reindexed_chunks",
    f"""with {CORR}, newest as (select document_id, max_by((original_text, corrected_text), (us, correction_id)) as c from corr where document_id is not null and us is not null and coalesce(original_text, '') <> '' and corrected_text is not null group by 1),
    d as (select doc_id, deleted_at is not null as is_deleted, n.c is not null as touched, case when n.c is null then text else replace(text, struct_extract_at(n.c, 1), struct_extract_at(n.c, 2)) end as new_text, text from (select *, {sql_id('id')} as nid from documents) x left join newest n on n.document_id = x.nid),
    w as (select doc_id, is_deleted, touched, v.old, list_filter(regexp_split_to_array(coalesce(case when v.old then text else new_text end, ''), '[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+'), lambda x: x <> '') as w from d, (select true as old union all select false) v where v.old or touched),
    c as (select doc_id, is_deleted, touched, old, w[i + 1 : i + 256] as p, i from (select *, unnest(range(0, len(w), 64)) as i from w where len(w) >= 10)),
    k as (select *, cast(row_number() over (partition by doc_id, old order by i) - 1 as int) as chunk_index from c where len(p) >= 10),
    best as (select *, row_number() over (partition by doc_id, chunk_index order by old) as rn from k)
    select doc_id, chunk_index, md5(array_to_string(p, ' ')) as chunk_md5, not old as is_new, is_deleted, old and touched as is_stale from best where rn = 1""",
)
def reindexed_chunks(spark, sf_dir):
    """Documents whose text a correction changes are chunked anew, and the new points replace the old ones of their id.

    The newest correction's reading is put in place of the machine's. Old points without a successor are stale; all
    points of deleted documents say so. Only touched documents are chunked twice.
    """
    c = corrections(spark, sf_dir).where("document_id is not null and at is not null and coalesce(original_text, '') <> '' and corrected_text is not null")
    newest = c.groupBy("document_id").agg(F.max_by(F.struct("original_text", "corrected_text"), F.struct("at", "correction_id")).alias("c"))
    d = read_table(spark, sf_dir, "documents").select("doc_id", norm_id("id").alias("document_id"), F.col("deleted_at").isNotNull().alias("is_deleted"), "text").join(newest, "document_id", "left")
    about = d.select("doc_id", "is_deleted", F.col("c").isNotNull().alias("touched"))
    old = op.chunks(d, "doc_id", "text").withColumn("is_new", F.lit(False))
    new = op.chunks(d.where("c is not null").select("doc_id", F.replace("text", F.col("c.original_text"), F.col("c.corrected_text")).alias("t")), "doc_id", "t").withColumn("is_new", F.lit(True))
    points = op.keep_latest(old.unionByName(new).withColumn("point", F.concat_ws("_", "doc_id", "chunk_index")), "point", F.col("is_new").desc())
    return points.join(about, "doc_id").select("doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"), "is_new", "is_deleted", (~F.col("is_new") & F.col("touched")).alias("is_stale"))
