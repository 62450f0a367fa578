"""The relational entities with ids in one spelling and rows delivered twice taken once, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import norm_id, sql_id
from ..functions.times import read_time
from ..session import read_table


def documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.withColumn("id", norm_id("id"))


def sessions(spark, sf_dir):
    s = read_table(spark, sf_dir, "query_sessions")
    return s.select(norm_id("id").alias("id"), "query_text", "queried_at", norm_id("user_id").alias("user_id"), "is_test_account", "result_doc_ids").dropDuplicates(["id"])


def feedback(spark, sf_dir):
    f = read_table(spark, sf_dir, "search_feedback")
    return f.select(norm_id("id").alias("id"), norm_id("session_id").alias("session_id"), norm_id("document_id").alias("document_id"), "feedback_type", "created_at").distinct()


def corrections(spark, sf_dir):
    c = read_table(spark, sf_dir, "corrections")
    return c.select(
        norm_id("correction_id").alias("correction_id"), norm_id("region_id").alias("region_id"), norm_id("document_id").alias("document_id"), "corrected_text", "original_text",
        read_time("corrected_at").alias("at"), norm_id("user_id").alias("user_id"), "crop_s3_url", "opted_in", "excluded_from_training", "archived_at",
    ).distinct()


def regions(spark, sf_dir):
    r = read_table(spark, sf_dir, "handwritten_regions")
    return r.select(norm_id("id").alias("id"), norm_id("page_id").alias("page_id"), "crop_s3_url", "htr_output", "htr_confidence", "created_at").distinct()


def pages(spark, sf_dir):
    p = read_table(spark, sf_dir, "document_pages")
    return p.select(norm_id("id").alias("id"), norm_id("document_id").alias("document_id"), "page_number", "htr_confidence", "htr_flagged", "created_at").distinct()


AT_SQL = """try_cast(case when regexp_matches(trim(corrected_at), '^\\d{4}-\\d{2}-\\d{2}$') then trim(corrected_at) || 'T00:00:00Z'
  when not regexp_matches(trim(corrected_at), '^\\d{4}-\\d{2}-\\d{2}') then null
  when regexp_matches(lower(trim(corrected_at)), '(z|utc|gmt|[+-]\\d{2}:?\\d{0,2})$') then trim(corrected_at) else trim(corrected_at) || 'Z' end as timestamptz)"""
DOCS = f"docs as (select * exclude (id), {sql_id('id')} as id from documents)"
SESS = f"sess as (select {sql_id('id')} as id, any_value(query_text) as query_text, any_value(queried_at) as queried_at, any_value({sql_id('user_id')}) as user_id, any_value(is_test_account) as is_test_account, any_value(result_doc_ids) as result_doc_ids from query_sessions group by 1)"
FB = f"fb as (select distinct {sql_id('id')} as id, {sql_id('session_id')} as session_id, {sql_id('document_id')} as document_id, feedback_type, created_at from search_feedback)"
CORR = f"""corr as (select distinct {sql_id('correction_id')} as correction_id, {sql_id('region_id')} as region_id, {sql_id('document_id')} as document_id, corrected_text, original_text,
  epoch_us({AT_SQL}) as us, {sql_id('user_id')} as user_id, crop_s3_url, opted_in, excluded_from_training, archived_at from corrections)"""
REGS = f"regs as (select distinct {sql_id('id')} as id, {sql_id('page_id')} as page_id, crop_s3_url, htr_output, htr_confidence, created_at from handwritten_regions)"
PAGES = f"pgs as (select distinct {sql_id('id')} as id, {sql_id('document_id')} as document_id, page_number, htr_confidence, htr_flagged, created_at from document_pages)"
