"""Queries on search feedback: labelled pairs, negatives, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import norm_id, sql_id
from ..operators import feedback as op
from ..operators.order import numbered
from ..session import stage
from .registry import CORE
from .views import DOCS, FB, SESS, documents, feedback, sessions

AS_OF = "2016-02-01 00:00:00"

_PAIRS = f"""{DOCS}, {SESS}, {FB},
joined as (select fb.id, fb.session_id, fb.document_id, fb.feedback_type, sess.query_text, sess.queried_at, sess.user_id, docs.merged_text as doc_text
  from fb join sess on fb.session_id = sess.id join docs on fb.document_id = docs.id
  where sess.is_test_account = false and docs.deleted_at is null and fb.feedback_type in ('click', 'thumbs_up', 'thumbs_down')),
firsts as (select * from (select *, row_number() over (partition by user_id, query_text, date_trunc('minute', queried_at) order by queried_at, session_id, document_id, feedback_type, id) as rn from joined) where rn = 1),
pairs as (select substr(md5(session_id || ':' || document_id || ':' || (case when feedback_type in ('click', 'thumbs_up') then '1' else '0' end)), 1, 12) as triplet_id, session_id, query_text, document_id as doc_id,
  case when coalesce(doc_text, '') = '' then '(no text)' else substr(doc_text, 1, 500) end as chunk_text, feedback_type,
  cast(case when feedback_type in ('click', 'thumbs_up') then 1 else 0 end as int) as label, strftime(queried_at, '%Y-%m-%d') as query_date, queried_at,
  case when queried_at < timestamp '{AS_OF}' - interval 7 days then 'train' else 'val' end as split from firsts)
"""
_NEG = """,
p as (select *, md5(session_id || '|' || doc_id || '|' || feedback_type || coalesce('|' || query_text, '')) as h from pairs where label = 1 and chunk_text <> '(no text)'),
nb as (select greatest(1, count(*) // 1000) as nb from p),
dealt as (select p.*, nb, cast('0x' || substr(h, 1, 8) as bigint) % nb as b from p, nb),
ranked as (select *, row_number() over (partition by b order by h, triplet_id) as rn, count(*) over (partition by b) as n from dealt),
sizes as (select b as pb, count(*) as pn from ranked group by 1),
want as (select r.*, s.pb, cast('0x' || substr(md5(h || 'neg'), 9, 8) as bigint) % s.pn + 1 as pick from ranked r join sizes s on s.pb = cast('0x' || substr(md5(h || 'neg'), 1, 8) as bigint) % nb where rn <= n // 2),
neg as (select w.session_id, w.query_text, 'synthetic_neg' as doc_id, o.chunk_text as chunk_text, cast(0 as int) as label, w.query_date, w.queried_at, w.split from want w join ranked o on o.b = w.pb and o.rn = w.pick where o.chunk_text <> w.chunk_text)
"""


def _pairs(spark, sf_dir):
    rows = op.explicit_feedback(feedback(spark, sf_dir), sessions(spark, sf_dir), documents(spark, sf_dir))
    return op.time_split(op.labelled(op.first_of_reformulations(rows)), "queried_at", AS_OF)


@CORE.add("feedback_pairs", f"with {_PAIRS} select * exclude (queried_at) from pairs")
def feedback_pairs(spark, sf_dir):
    """Labelled query-document pairs with their split."""
    return _pairs(spark, sf_dir).drop("queried_at")


@CORE.add(
    "reformulation_gap",
    f"with {SESS} select id, user_id, query_text, queried_at from (select *, lag(queried_at) over (partition by user_id, query_text order by queried_at, id) as p from sess) where p is null or queried_at > p + interval 5 minutes",
)
def reformulation_gap(spark, sf_dir):
    """Searches not repeated within five minutes by the same user."""
    s = sessions(spark, sf_dir).select("id", "user_id", "query_text", "queried_at")
    return op.gap_dedup(s, ["user_id", "query_text"], "queried_at", 5)


@CORE.add("time_split_counts", f"with {_PAIRS} select split, label, count(*) as n_pairs from pairs group by 1, 2")
def time_split_counts(spark, sf_dir):
    """Pairs for each split and label."""
    return _pairs(spark, sf_dir).groupBy("split", "label").agg(F.count("*").alias("n_pairs"))


@CORE.add("synthetic_negatives", f"with {_PAIRS} {_NEG} select * exclude (queried_at, split) from neg")
def synthetic_negatives(spark, sf_dir):
    """Negatives drawn from other positives."""
    return op.synthetic_negatives(stage(_pairs(spark, sf_dir))).drop("queried_at")


@CORE.add(
    "retrieval_training_set",
    f"with {_PAIRS} {_NEG} select session_id, query_text, doc_id, md5(chunk_text) as chunk_md5, label, query_date, split from pairs union all select session_id, query_text, doc_id, md5(chunk_text), label, query_date, split from neg",
)
def retrieval_training_set(spark, sf_dir):
    """Pairs and synthetic negatives in one set."""
    p = stage(_pairs(spark, sf_dir))  # used for both sides
    n = op.time_split(op.synthetic_negatives(p), "queried_at", AS_OF)
    cols = ["session_id", "query_text", "doc_id", F.md5("chunk_text").alias("chunk_md5"), "label", "query_date", "split"]
    return p.select(*cols).unionByName(n.select(*cols))


@CORE.add(
    "session_true_triplets",
    f"""with {_PAIRS} select distinct a.session_id, a.query_text, a.document_id as pos_doc, b.document_id as neg_doc from joined a join joined b on a.session_id = b.session_id
    where a.feedback_type in ('click', 'thumbs_up') and b.feedback_type = 'thumbs_down' and a.document_id <> b.document_id""",
)
def session_true_triplets(spark, sf_dir):
    """Query, positive and negative document of the same search, from all explicit feedback."""
    p = op.explicit_feedback(feedback(spark, sf_dir), sessions(spark, sf_dir), documents(spark, sf_dir))
    a = p.where("feedback_type <> 'thumbs_down'").select("session_id", "query_text", F.col("document_id").alias("pos_doc"))
    b = p.where("feedback_type = 'thumbs_down'").select("session_id", F.col("document_id").alias("neg_doc"))
    return a.join(b, "session_id").where("pos_doc <> neg_doc").distinct()


_SHOWN = f"shown as (select id as session_id, {sql_id('d')} as document_id, rank from (select id, unnest(result_doc_ids) as d, generate_subscripts(result_doc_ids, 1) as rank from sess) where {sql_id('d')} is not null)"


def _shown(spark, sf_dir):
    s = sessions(spark, sf_dir).select(F.col("id").alias("session_id"), F.posexplode("result_doc_ids").alias("p", "d"))
    return s.select("session_id", norm_id("d").alias("document_id"), (F.col("p") + 1).cast("bigint").alias("rank")).where("document_id is not null")


@CORE.add(
    "unclicked_negatives",
    f"with {SESS}, {FB}, {_SHOWN} select s.session_id, s.document_id, s.rank from shown s where not exists (select 1 from fb where fb.session_id = s.session_id and fb.document_id = s.document_id)",
)
def unclicked_negatives(spark, sf_dir):
    """Documents shown for a search without any feedback on them."""
    return _shown(spark, sf_dir).join(feedback(spark, sf_dir).select("session_id", "document_id").distinct(), ["session_id", "document_id"], "left_anti").select("session_id", "document_id", "rank")


_STATS = f"""{SESS}, {FB}, {_SHOWN},
votes as (select document_id, count(*) filter (where feedback_type = 'thumbs_up') as thumbs_up, count(*) filter (where feedback_type = 'thumbs_down') as thumbs_down, count(*) filter (where feedback_type = 'click') as clicks from fb where document_id is not null group by 1),
impr as (select document_id, count(*) as total_impressions from shown group by 1),
stats as (select coalesce(v.document_id, i.document_id) as document_id, coalesce(thumbs_up, 0) as thumbs_up, coalesce(thumbs_down, 0) as thumbs_down, coalesce(clicks, 0) as clicks, coalesce(total_impressions, 0) as total_impressions,
  case when coalesce(thumbs_up, 0) + coalesce(thumbs_down, 0) = 0 then 0.0 else round(thumbs_up / cast(thumbs_up + thumbs_down as double), 6) end as up_rate,
  case when coalesce(thumbs_up, 0) + coalesce(thumbs_down, 0) = 0 then 0.0 else round(thumbs_down / cast(thumbs_up + thumbs_down as double), 6) end as down_rate
  from votes v full join impr i on v.document_id = i.document_id)"""


def feedback_stats(fb, shown):
    """Votes, clicks, impressions and rates of each document; rates are shares of the votes, 0 without votes."""
    kinds = (("thumbs_up", "thumbs_up"), ("thumbs_down", "thumbs_down"), ("click", "clicks"))
    votes = fb.where("document_id is not null").groupBy("document_id").agg(*(F.sum((F.col("feedback_type") == k).cast("bigint")).alias(n) for k, n in kinds))
    impr = shown.groupBy("document_id").agg(F.count("*").alias("total_impressions"))
    s = votes.join(impr, "document_id", "full").na.fill(0, ["thumbs_up", "thumbs_down", "clicks", "total_impressions"])
    total = (F.col("thumbs_up") + F.col("thumbs_down")).cast("double")
    rate = lambda c: F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(F.col(c), total), 6))
    return s.withColumn("up_rate", rate("thumbs_up")).withColumn("down_rate", rate("thumbs_down"))


@CORE.add("doc_feedback_stats", f"with {_STATS} select * from stats")
def doc_feedback_stats(spark, sf_dir):
    """The feedback statistics of all documents, rebuilt whole."""
    return feedback_stats(feedback(spark, sf_dir), _shown(spark, sf_dir))


@CORE.add(
    "ctr_rates",
    f"""with {SESS}, {FB}, {_SHOWN},
    i as (select strftime(s.queried_at, '%Y-%m-%d') as day, count(*) as impressions from shown h join sess s on h.session_id = s.id group by 1),
    f as (select strftime(created_at, '%Y-%m-%d') as day, count(*) filter (where feedback_type = 'click') as clicks, count(*) filter (where feedback_type = 'thumbs_down') as downs, count(*) as votes from fb group by 1)
    select i.day, impressions, coalesce(clicks, 0) as clicks, round(coalesce(clicks, 0) / cast(impressions as double), 6) as ctr, round(coalesce(downs, 0) / cast(coalesce(votes, 1) as double), 6) as down_share from i left join f on i.day = f.day""",
)
def ctr_rates(spark, sf_dir):
    """A10: click-through and thumbs-down shares for each day."""
    days = sessions(spark, sf_dir).select(F.col("id").alias("session_id"), F.date_format("queried_at", "yyyy-MM-dd").alias("day"))
    i = _shown(spark, sf_dir).join(days, "session_id").groupBy("day").agg(F.count("*").alias("impressions"))
    t = F.col("feedback_type")
    f = feedback(spark, sf_dir).groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(F.sum((t == "click").cast("bigint")).alias("clicks"), F.sum((t == "thumbs_down").cast("bigint")).alias("downs"), F.count("*").alias("votes"))
    j = i.join(f, "day", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select("day", "impressions", zero("clicks").alias("clicks"), F.round(zero("clicks") / F.col("impressions").cast("double"), 6).alias("ctr"), F.round(zero("downs") / F.coalesce("votes", F.lit(1)).cast("double"), 6).alias("down_share"))


@CORE.add(
    "rerank_results",
    f"with {_STATS} select h.session_id, h.document_id, h.rank, round((1.0 / h.rank) * (1 + 0.5 * (coalesce(t.up_rate, 0) - coalesce(t.down_rate, 0))), 6) as score from shown h left join stats t on h.document_id = t.document_id",
)
def rerank_results(spark, sf_dir):
    """Results boosted and demoted by their votes: score * (1 + 0.5 * (up_rate - down_rate)), score 1 / rank."""
    shown = _shown(spark, sf_dir)
    stats = feedback_stats(feedback(spark, sf_dir), shown).select("document_id", "up_rate", "down_rate")
    lift = 1 + 0.5 * (F.coalesce("up_rate", F.lit(0.0)) - F.coalesce("down_rate", F.lit(0.0)))
    return shown.join(stats, "document_id", "left").select("session_id", "document_id", "rank", F.round((1.0 / F.col("rank")) * lift, 6).alias("score"))


@CORE.add(
    "retrieval_manifest",
    f"with {_PAIRS} select cast(count(*) as bigint) as total, count(*) filter (where split = 'train') as train, count(*) filter (where split = 'val') as val, count(*) filter (where label = 1) as positives, cast(ceil(count(*) filter (where split = 'train') / 500.0) as bigint) as train_shards, cast(ceil(count(*) filter (where split = 'val') / 500.0) as bigint) as val_shards from pairs",
)
def retrieval_manifest(spark, sf_dir):
    """The counts of a snapshot, in one pass."""
    n = lambda c: F.sum(c.cast("bigint"))
    t, v = n(F.col("split") == "train"), n(F.col("split") == "val")
    return _pairs(spark, sf_dir).agg(F.count("*").alias("total"), t.alias("train"), v.alias("val"), n(F.col("label") == 1).alias("positives"), F.ceil(t / 500).alias("train_shards"), F.ceil(v / 500).alias("val_shards"))


@CORE.add("feedback_in_order", f"with {_PAIRS} select row_number() over (order by queried_at nulls first, session_id, doc_id, feedback_type) as position, session_id, doc_id, feedback_type from pairs")
def feedback_in_order(spark, sf_dir):
    """The labelled pairs with their place by time of the search, ties by session, document and type."""
    p = _pairs(spark, sf_dir).select("queried_at", "session_id", "doc_id", "feedback_type")
    return numbered(p, [], ["queried_at", "session_id", "doc_id", "feedback_type"], "position").drop("queried_at")
