"""Differential check: Spark queries against their DuckDB oracle text on the same parquet."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.check_oracles import compare, duck

SUBSET = ["agg_dual_class", "agg_content_trends", "agg_company_combined", "agg_trend_pivot", "agg_summary",
          "flt_keyword_any", "flt_relevance", "flt_labelable", "prj_clean_text", "prj_split_list", "prj_relative_age",
          "prj_content_hash", "join_ticker_mentions", "agg_mentions_trend", "win_item_budget", "win_comment_cap",
          "dedup_content", "agg_filter_funnel", "job_ingest", "job_search", "top_search_sample", "enr_sentiment",
          "enr_content_type", "ml_split", "agg_class_report", "mon_alarm", "lbl_ai_label", "src_raw_batch",
          "snk_csv", "stm_daily_trend"]


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", SUBSET)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF0001)
    assert r["ok"], r


def test_every_query_has_a_callable_and_most_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 100
