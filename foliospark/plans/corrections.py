"""Queries on corrections: rules, training set, review queue."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import bucket_10000, sql_bucket, uuid5_dns
from ..operators import corrections as op
from ..operators import quality
from ..operators.order import numbered
from .registry import CORE
from .views import CORR, DOCS, FB, PAGES, REGS, corrections, documents, feedback, pages, regions

_WS = r"[\s\x0b\x1c-\x1f\x85\pZ]"


def _strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"


_C, _O = f"lower({_strip('corrected_text')})", f"lower({_strip('original_text')})"
_REASON = f"""case when {_C} = '' then 'R2' when length(coalesce(corrected_text, '')) > 2000 then 'R5' when {_O} <> '' and {_O} = {_C} then 'R1'
  when not starts_with(coalesce(crop_s3_url, ''), 's3://') then 'R3'"""
_BASE = f"{CORR}, judged as (select *, {_REASON} end as reason from corr)"


@CORE.add("quality_reasons", f"with {_BASE} select correction_id, reason from judged")
def quality_reasons(spark, sf_dir):
    """Q-R1 Q-R2 Q-R3 Q-R5: the rule each correction breaks, null where it is accepted."""
    return corrections(spark, sf_dir).select("correction_id", quality.reason().alias("reason"))


@CORE.add(
    "quality_report",
    f"""with {_BASE}, ranked as (select *, row_number() over (partition by reason order by correction_id) as rn from judged where reason is not null)
    select reason, count(*) as n, list(substr(coalesce(corrected_text, ''), 1, 80) order by rn) filter (where rn <= 5) as samples from ranked group by reason""",
)
def quality_report(spark, sf_dir):
    """Rejections for each reason with up to five samples."""
    return quality.report(corrections(spark, sf_dir).withColumn("reason", quality.reason()), "correction_id")


@CORE.add(
    "quality_missing_crops",
    f"""with {CORR}, {REGS}, listing as (select distinct crop_s3_url from regs where crop_s3_url is not null),
    judged as (select c.*, {_REASON} when not regexp_matches(coalesce(crop_s3_url, ''), '^s3://[^/]*/') then 'R3' when l is null then 'R4' end as reason
      from (select corr.*, listing.crop_s3_url as l from corr left join listing using (crop_s3_url)) c)
    select coalesce(reason, 'accepted') as reason, count(*) as n from judged group by 1""",
)
def quality_missing_crops(spark, sf_dir):
    """Q-R4 J08: the rules with a listing of the crops that exist."""
    listing = regions(spark, sf_dir).where("crop_s3_url is not null").select("crop_s3_url").distinct().withColumn("object_exists", F.lit(True))
    c = corrections(spark, sf_dir).join(listing, "crop_s3_url", "left")
    return c.groupBy(F.coalesce(quality.reason(with_listing=True), F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


_ELIGIBLE = f"""{CORR}, {DOCS}, elig as (select * from corr where coalesce(opted_in, false) and {_strip('corrected_text')} <> '' and document_id in (select id from docs where source = 'user_upload' and deleted_at is null)),
latest as (select * from (select *, row_number() over (partition by region_id order by us desc nulls last, correction_id, corrected_text, crop_s3_url) as rn from elig where region_id is not null) where rn = 1)"""


def _latest(spark, sf_dir):
    return op.newest_per_region(op.eligible(corrections(spark, sf_dir), documents(spark, sf_dir)))


@CORE.add("corrections_latest", f"with {_ELIGIBLE} select region_id, correction_id, document_id, corrected_text from latest")
def corrections_latest(spark, sf_dir):
    """The newest eligible correction of each region."""
    return _latest(spark, sf_dir).select("region_id", "correction_id", "document_id", "corrected_text")


@CORE.add(
    "htr_training_set",
    f"""with {_ELIGIBLE} select region_id, crop_s3_url, corrected_text, coalesce(original_text, '') as original_text, 'user_correction' as source,
    case when {sql_bucket('document_id')} < 2000 then 'val' else 'train' end as split, strftime(make_timestamp(us), '%Y-%m-%d') as correction_date,
    case when coalesce(user_id, '') = '' then 'unknown' else user_id end as writer_id from (select *, {_REASON} end as reason from latest) where reason is null""",
)
def htr_training_set(spark, sf_dir):
    """Accepted newest corrections as training rows; newest first, then the rules, in this order."""
    rows = op.document_split(_latest(spark, sf_dir).withColumn("reason", quality.reason()).where("reason is null"))
    return rows.select(
        "region_id", "crop_s3_url", "corrected_text", F.coalesce("original_text", F.lit("")).alias("original_text"), F.lit("user_correction").alias("source"),
        "split", F.date_format("at", "yyyy-MM-dd").alias("correction_date"), F.when(F.coalesce("user_id", F.lit("")) == "", "unknown").otherwise(F.col("user_id")).alias("writer_id"),
    )


@CORE.add("hash_split", f"with {DOCS} select id, cast({sql_bucket('id')} as bigint) as bucket, case when {sql_bucket('id')} < 2000 then 'val' else 'train' end as split from docs")
def hash_split(spark, sf_dir):
    """The split of every document by its hash."""
    return op.document_split(documents(spark, sf_dir), "id").select("id", bucket_10000("id").alias("bucket"), "split")


@CORE.add("split_overlap_check", f"with {_ELIGIBLE}, s as (select document_id, case when {sql_bucket('document_id')} < 2000 then 'val' else 'train' end as split from latest) select (select count(*) from (select document_id from s where split = 'train' intersect select document_id from s where split = 'val')) as n_overlap, (select count(distinct document_id) from s where split = 'train') as train_docs, (select count(distinct document_id) from s where split = 'val') as val_docs")
def split_overlap_check(spark, sf_dir):
    """Documents of both splits, which must be none."""
    per = op.document_split(_latest(spark, sf_dir)).groupBy("document_id").agg(F.max((F.col("split") == "train").cast("bigint")).alias("t"), F.max((F.col("split") == "val").cast("bigint")).alias("v"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(total(F.col("t") * F.col("v")).alias("n_overlap"), total("t").alias("train_docs"), total("v").alias("val_docs"))


@CORE.add(
    "review_queue",
    f"""with {REGS}, {PAGES}, {CORR} select p.document_id, r.id as region_id, r.htr_confidence, case when r.htr_confidence >= 0.85 then 'high' when r.htr_confidence >= 0.6 then 'medium' else 'low' end as badge
    from regs r join pgs p on r.page_id = p.id where p.htr_flagged and not exists (select 1 from corr where corr.region_id = r.id)""",
)
def review_queue(spark, sf_dir):
    """Regions of flagged pages nobody has corrected, with a badge for the confidence."""
    r, p = regions(spark, sf_dir), pages(spark, sf_dir).where("htr_flagged")
    j = r.join(p.select(F.col("id").alias("page_id"), "document_id"), "page_id").join(corrections(spark, sf_dir).select(F.col("region_id").alias("id")).where("id is not null").distinct(), "id", "left_anti")
    badge = F.when(F.col("htr_confidence") >= 0.85, "high").when(F.col("htr_confidence") >= 0.6, "medium").otherwise("low")
    return j.select("document_id", F.col("id").alias("region_id"), "htr_confidence", badge.alias("badge"))


@CORE.add("low_confidence_regions", f"with {REGS} select id, page_id, htr_confidence from regs where htr_confidence < 0.6")
def low_confidence_regions(spark, sf_dir):
    """Regions recognised with a confidence below the threshold of 0.6."""
    return regions(spark, sf_dir).where("htr_confidence < 0.6").select("id", "page_id", "htr_confidence")


@CORE.add(
    "writer_dup_7d",
    f"""with {CORR} select correction_id, user_id, corrected_text from (select *, lag(us) over (partition by user_id, corrected_text order by us, correction_id, region_id) as p from corr where user_id is not null and us is not null)
    where p is not null and us - p <= 7 * 86400000000""",
)
def writer_dup_7d(spark, sf_dir):
    """Corrections that repeat a text of the same writer within seven days."""
    c = corrections(spark, sf_dir).where("user_id is not null and at is not null")
    w = Window.partitionBy("user_id", "corrected_text").orderBy("at", "correction_id", "region_id")
    return c.withColumn("p", F.lag("at").over(w)).where("p is not null and at <= p + interval 7 days").select("correction_id", "user_id", "corrected_text")


@CORE.add("archive_pending", f"with {CORR} select document_id, count(*) as n_pending from corr where archived_at is null group by 1")
def archive_pending(spark, sf_dir):
    """corrections not archived yet, for each document."""
    return corrections(spark, sf_dir).where("archived_at is null").groupBy("document_id").agg(F.count("*").alias("n_pending"))


@CORE.add("original_lookup", f"with {CORR}, {REGS} select c.correction_id, c.region_id, coalesce(r.htr_output, '') as original_text from corr c left join regs r on c.region_id = r.id")
def original_lookup(spark, sf_dir):
    """The machine's reading of each correction's region, '' where there is none."""
    r = regions(spark, sf_dir).select(F.col("id").alias("region_id"), F.coalesce("htr_output", F.lit("")).alias("o"))
    return corrections(spark, sf_dir).select("correction_id", "region_id").join(r, "region_id", "left").select("correction_id", "region_id", F.coalesce("o", F.lit("")).alias("original_text"))


@CORE.add("region_uuid5", f"""with {REGS} select id, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || substr('89ab', cast(cast('0x' || substr(d, 17, 1) as bigint) % 4 + 1 as int), 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) as point_id
    from (select id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(id)) as d from regs)""")
def region_uuid5(spark, sf_dir):
    """Stable point ids of regions."""
    return regions(spark, sf_dir).select("id", uuid5_dns(F.col("id")).alias("point_id"))


@CORE.add(
    "asof_text",
    f"""with {CORR}, {FB} select f.id, f.document_id, (select max_by(c.corrected_text, (c.us, c.corrected_text)) from corr c where c.document_id = f.document_id and c.us <= epoch_us(f.created_at)) as corrected_text
    from fb f where f.document_id is not null""",
)
def asof_text(spark, sf_dir):
    """Each feedback with the newest correction of its document at that time."""
    e = feedback(spark, sf_dir).select("document_id", "id", F.col("created_at").cast("timestamp").alias("t"))
    v = corrections(spark, sf_dir).where("corrected_text is not null").select("document_id", "at", "corrected_text").distinct()
    return op.as_of(e, v, "document_id", "t", "at", "corrected_text").select("id", "document_id", "corrected_text")


@CORE.add("confirmed_merge", f"with {DOCS} select id, coalesce(tesseract_text, '') || case when coalesce(tesseract_text, '') <> '' and coalesce(htr_text, '') <> '' then chr(10) else '' end || coalesce(htr_text, '') as merged from docs")
def confirmed_merge(spark, sf_dir):
    """Printed and handwritten text put together, for every document."""
    some = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    return documents(spark, sf_dir).select("id", F.concat_ws("\n", some("tesseract_text"), some("htr_text")).alias("merged"))


@CORE.add(
    "review_queue_nested",
    f"""with {REGS}, {PAGES}, {CORR}, q as (select distinct p.document_id, r.id, r.page_id, case when r.htr_confidence >= 0.85 then 'high' when r.htr_confidence >= 0.6 then 'medium' else 'low' end as badge
      from regs r join pgs p on r.page_id = p.id where p.htr_flagged and p.document_id is not null and not exists (select 1 from corr where corr.region_id = r.id))
    select document_id, count(*) as n_regions, to_json(list({{'region_id': id, 'page_id': page_id, 'badge': badge}} order by id, badge)) as regions from q group by 1""",
)
def review_queue_nested(spark, sf_dir):
    """The review queue nested, a document with its regions in order; a document's pages bound its list."""
    r, p = regions(spark, sf_dir), pages(spark, sf_dir).where("htr_flagged and document_id is not null")
    j = r.join(p.select(F.col("id").alias("page_id"), "document_id"), "page_id").join(corrections(spark, sf_dir).select(F.col("region_id").alias("id")).where("id is not null").distinct(), "id", "left_anti")
    badge = F.when(F.col("htr_confidence") >= 0.85, "high").when(F.col("htr_confidence") >= 0.6, "medium").otherwise("low")
    q = j.select("document_id", F.col("id").alias("region_id"), "page_id", badge.alias("badge")).distinct()
    ordered = F.sort_array(F.collect_list(F.struct("region_id", "badge", "page_id")))
    nested = F.to_json(F.transform(ordered, lambda x: F.struct(x["region_id"], x["page_id"], x["badge"])))
    return q.groupBy("document_id").agg(F.count("*").alias("n_regions"), nested.alias("regions"))


@CORE.add("crop_keys", f"with {CORR} select correction_id, regexp_extract(coalesce(crop_s3_url, ''), '^s3://([^/]*)/(?s:.*)$', 1) as bucket, regexp_extract(coalesce(crop_s3_url, ''), '^s3://[^/]*/((?s:.*))$', 1) as key from corr")
def crop_keys(spark, sf_dir):
    """Bucket and key of each crop's address, '' where it names none."""
    url = F.coalesce("crop_s3_url", F.lit(""))
    part = lambda k: F.regexp_extract(url, r"(?s)^s3://([^/]*)/(.*)\z", k)
    return corrections(spark, sf_dir).select("correction_id", part(1).alias("bucket"), part(2).alias("key"))


@CORE.add(
    "candidates_in_order",
    f"with {_ELIGIBLE} select row_number() over (order by us nulls first, region_id) as position, region_id, correction_id from latest",
)
def candidates_in_order(spark, sf_dir):
    """The newest eligible corrections with their place by time, unreadable times first, ties by region."""
    return numbered(_latest(spark, sf_dir).select("region_id", "correction_id", "at"), [], ["at", "region_id"], "position").select("position", "region_id", "correction_id")
