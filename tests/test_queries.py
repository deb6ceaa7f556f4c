"""Every registered query against its SQL twin, and the shape of the plans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
from workload import QUERIES
from nomina.operators import sampling, tfidf
from workload.compare import mismatch
from workload.dataset_queries import prose_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, name):
    """Equal to its twin, and planned without pairwise joins."""
    df = entry_module.queries()[name](spark, sf_dir)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan_of(df))
    assert df.limit(1).count() == 1
    assert mismatch(df, sf_dir, name) is None


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["category", "cnt", "share", "labeled"]
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry_module.queries()["table_scan"](spark, sf_dir))
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    plan = plan_of(entry_module.queries()["clean_text"](spark, sf_dir))
    assert "l_extendedprice" not in plan.split("ReadSchema")[-1]


def test_tfidf_shuffles_the_texts_once(spark, sf_dir):
    rows = prose_table(spark, sf_dir)
    vocabulary = tfidf.tfidf_vocabulary(rows, "clean", max_features=100)
    plan = plan_of(tfidf.tfidf_weights(rows, "doc_id", "clean", vocabulary))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    counts = plan_of(tfidf.document_frequency(rows, "clean"))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", counts) == ["term"]


def test_capping_moves_no_rows(spark, sf_dir):
    rows = prose_table(spark, sf_dir)
    plan = plan_of(sampling.cap_per_class(rows, 50, ["doc_id"], by="lang"))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry_module.queries()["document_token_counts"](spark, sf_dir))
    assert len(re.findall(r"partial_sum", plan)) >= 1
