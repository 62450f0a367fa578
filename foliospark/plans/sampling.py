"""Queries on pools, question-answer negatives, hashed encodings and column checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import strip, words
from ..operators.feedback import bucketed
from ..operators.order import numbered
from ..session import read_table, stage
from .feedback import _PAIRS, _pairs
from .checks import _SPLIT, REQUIRED, _split
from .registry import CORE
from .views import SESS, sessions

POOL, DIM = 500, 64
_WS = r"[\s\x0b\x1c-\x1f\x85\pZ]"


@CORE.add(
    "pool_sample",
    f"""with {SESS}, pool as (select image_id, row_number() over (order by md5('pool:' || image_id), image_id) - 1 as k from (select distinct image_id from line_images where octet_length(image_png) > 0 and regexp_replace(coalesce(transcription, ''), '^{_WS}+|{_WS}+$', '', 'g') <> '') order by k limit 500),
    n as (select count(*) as n from pool)
    select s.id, p.image_id from sess s, n join pool p on p.k = cast('0x' || substr(md5('draw:' || s.id), 1, 8) as bigint) % n.n""",
)
def pool_sample(spark, sf_dir):
    """For every search a picture drawn with replacement from a pool of 500 that have a picture and a text."""
    ok = (F.octet_length("image_png") > 0) & (strip(F.coalesce("transcription", F.lit(""))) != "")
    some = read_table(spark, sf_dir, "line_images").where(ok).select("image_id").distinct().orderBy(F.md5(F.concat(F.lit("pool:"), "image_id")), "image_id").limit(POOL)
    # the pool's size is its parameter; it is numbered and broadcast
    pool = some.withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.md5(F.concat(F.lit("pool:"), "image_id")), "image_id")) - 1).withColumn("n", F.count("*").over(Window.partitionBy(F.lit(0))))
    size = pool.agg(F.max("n").alias("n"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("draw:"), "id")), 1, 8), 16, 10).cast("bigint")
    s = sessions(spark, sf_dir).select("id").join(F.broadcast(size), F.lit(True)).withColumn("k", (draw % F.col("n")).cast("int"))
    return s.join(F.broadcast(pool.select("k", "image_id")), "k").select("id", "image_id")


@CORE.add(
    "qa_triplets",
    f"""with {_PAIRS}, p as (select query_text, doc_id, chunk_text, md5(session_id || '|' || doc_id || '|' || feedback_type) as h from pairs where label = 1),
    d as (select *, cast('0x' || substr(h, 1, 8) as bigint) % (select greatest(1, count(*) // 1000) from p) as b from p),
    r as (select *, lead(doc_id) over w as other, lead(chunk_text) over w as other_text from d window w as (partition by b order by h, query_text))
    select query_text as query, doc_id, md5(chunk_text) as passage_md5, 1 as label from p union all select query_text, other, md5(other_text), 0 from r where other <> doc_id""",
)
def qa_triplets(spark, sf_dir):
    """Each positive passage and, with label 0, the next one in hash order where it is of another document."""
    p = stage(_pairs(spark, sf_dir).where("label = 1")).select("query_text", "doc_id", "chunk_text", F.md5(F.concat_ws("|", "session_id", "doc_id", "feedback_type")).alias("h"))
    w = Window.partitionBy("b").orderBy("h", "query_text")
    r = bucketed(p).withColumn("other", F.lead("doc_id").over(w)).withColumn("other_text", F.lead("chunk_text").over(w)).where("other <> doc_id")
    pos = p.select(F.col("query_text").alias("query"), "doc_id", F.md5("chunk_text").alias("passage_md5"), F.lit(1).alias("label"))
    return pos.unionByName(r.select(F.col("query_text").alias("query"), F.col("other").alias("doc_id"), F.md5("other_text").alias("passage_md5"), F.lit(0).alias("label")))


@CORE.add(
    "hashed_embeddings",
    rf"""with w as (select doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_WS}+'), lambda x: x <> '')) as w from documents),
    b as (select doc_id, cast(cast('0x' || substr(md5(w), 1, 8) as bigint) % 64 as int) as bucket, count(*) as n from w group by 1, 2)
    select doc_id, bucket, round(n / sqrt(sum(cast(n as double) * n) over (partition by doc_id)), 6) as weight from b""",
)
def hashed_embeddings(spark, sf_dir):
    """A stand-in encoder, not the product's model: words hashed to 64 places, of unit length, as sparse rows."""
    w = read_table(spark, sf_dir, "documents").select("doc_id", F.explode(words(F.lower("text"))).alias("w"))
    bucket = (F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("bigint") % DIM).cast("int")
    b = w.groupBy("doc_id", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    norm = F.sqrt(F.sum(F.col("n").cast("double") * F.col("n")).over(Window.partitionBy("doc_id")))
    return b.select("doc_id", "bucket", F.round(F.col("n") / norm, 6).alias("weight"))


@CORE.add("time_split_14d", f"with {_PAIRS} select case when queried_at < timestamp '2016-02-01' - interval 14 days then 'train' else 'val' end as split, count(*) as n from pairs group by 1")
def time_split_14d(spark, sf_dir):
    """The time split with fourteen days."""
    cutoff = F.lit("2016-02-01").cast("timestamp_ntz") - F.expr("interval 14 days")
    return _pairs(spark, sf_dir).groupBy(F.when(F.col("queried_at") < cutoff, "train").otherwise("val").alias("split")).agg(F.count("*").alias("n"))


@CORE.add("required_columns", "select c as column_name, exists (select 1 from duckdb_columns() k where k.table_name = 'line_images' and k.column_name = c) as present from (select unnest(['image_id', 'image_png', 'transcription', 'split']) as c)")
def required_columns(spark, sf_dir):
    """Q-I2: which required columns the pictures' table has; read from the schema alone."""
    have = read_table(spark, sf_dir, "line_images").columns
    return spark.createDataFrame([(c, c in have) for c in REQUIRED], "column_name string, present boolean")


@CORE.add(
    "shard_quota",
    f"""with i as (select distinct image_id, {_SPLIT} as split from line_images), r as (select *, row_number() over (partition by split order by image_id) - 1 as k, count(*) over (partition by split) as n from i)
    select split, cast(k // 500 as bigint) as shard, count(*) as n_taken from r where k // 500 < 3 and k % 500 < 200 // least(3, (n + 499) // 500) group by 1, 2""",
)
def shard_quota(spark, sf_dir):
    """How many pictures are looked at in the first three shards of 500 of each split: 200 dealt evenly to these shards."""
    i = read_table(spark, sf_dir, "line_images").select("image_id", _split().alias("split")).distinct()
    r = stage(numbered(i, ["split"], ["image_id"], "k"))
    n = r.groupBy("split").agg(F.count("*").alias("n"))
    k = F.col("k") - 1
    quota = F.floor(F.lit(200) / F.least(F.lit(3), F.ceil(F.col("n") / 500)))
    return r.where("k <= 1500").join(n, "split").where(k % 500 < quota).groupBy("split", F.floor(k / 500).alias("shard")).agg(F.count("*").alias("n_taken"))
