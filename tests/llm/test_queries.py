"""The llm queries equal their SQL on the smallest tables; those without agree with counts that SQL can give."""

import os

import pytest

from foliospark.functions.ids import sql_id
from foliospark.llm.queries import LLM

from ..conftest import DATA

_R, _C = sql_id("region_id"), sql_id("correction_id")
#: A number of the query's rows, and the same in SQL. {q} are the query's rows.
COUNTS = {
    "p1_repaired": ("count(*)", f"select (select count(tesseract_text) + count(htr_text) + count(merged_text) from documents) + (select count(*) from (select distinct {sql_id('id')}, htr_output from handwritten_regions where htr_output is not null))"),
    "p2_survivors": ("count(*)", f"select count(distinct {_R}) from corrections where {_C} is not null"),
    "p3_pieces": ("count(distinct doc_id)", "select count(*) from documents where length(merged_text) > 2000"),
    "p7_splits": ("count(*)", "select count(*) from corrections"),
    "p8_ids": ("count(*)", "select count(*) from documents"),
    "p9_containers": ("count(distinct doc_id)", "select count(distinct doc_id) from documents"),
    "p9_fill": ("count(*)", "select 1"),
    "p10_scores": ("count(*)", "select count(*) from documents"),
    "p10_rates": ("sum(n_docs)", "select count(*) from documents"),
}
AT_LEAST = {
    "p1_found": "select count(*) from documents where tesseract_text is not null",
    "p6_found": "select count(*) from (select distinct a.image_id, b.image_id from line_images a join line_images b using (image_png) where lower(trim(a.split)) in ('validation', 'val', 'test') and lower(trim(b.split)) like 'train%' and octet_length(image_png) > 500)",
    "p6_report": "select 1",
}


def test_every_query_is_tested():
    assert {*COUNTS, *AT_LEAST, *LLM.sql, "p10_found"} == set(LLM.queries)


@pytest.mark.parametrize("name", sorted(LLM.sql))
def test_equals_sql(name, same):
    same(LLM.queries[name], LLM.sql[name])


def test_flagged_documents_agree_with_the_rates(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    found = LLM.queries["p10_found"](spark, DATA)
    assert found.columns == ["doc_id"] and found.distinct().count() == found.count() == LLM.queries["p10_rates"](spark, DATA).selectExpr("sum(n_flagged)").first()[0]


@pytest.mark.parametrize("name", sorted({*COUNTS, *AT_LEAST}))
def test_counts(name, spark, duck):
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    df = LLM.queries[name](spark, DATA)
    if name in COUNTS:
        ours, theirs = COUNTS[name]
        assert df.selectExpr(ours).first()[0] == duck.execute(theirs).fetchone()[0]
    else:
        assert df.count() >= duck.execute(AT_LEAST[name]).fetchone()[0]
