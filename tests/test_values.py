"""Every check says something: results hold both outcomes, or rows are both kept and dropped."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.check_oracles import duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name,column", [
    ("enr_parse_decision", "relevant"), ("enr_parse_decision", "relevant_strict"), ("enr_error_policy", "keep"), ("lbl_normalize", "label"),
    ("enr_content_type", "classification"), ("prj_class_result", "classification"), ("prj_class_fallback", "classification"),
    ("lbl_ai_label", "informative_emotional_label"), ("agg_confusion", "predicted"), ("win_sliding_quota", "accepted"), ("mon_alarm", "alarm"),
    ("enr_error_passthrough", "sentiment_error")])
def test_both_outcomes_occur(con, name, column):
    assert con.execute(f"SELECT count(DISTINCT coalesce(cast({column} AS varchar), '-')) FROM ({E.oracle_sql()[name]})").fetchone()[0] >= 2


def test_all_four_alarms_fire(con):
    assert con.execute(f"SELECT count(DISTINCT alarm) FROM ({E.oracle_sql()['mon_alarm']})").fetchone()[0] == 4


@pytest.mark.parametrize("name,whole", [
    ("flt_timeframe", "set_union_items"), ("win_daily_quota", None), ("src_newest_per_group", "flt_ticker_format"), ("top_extraction", "flt_extraction"),
    ("flt_ignore_any", None), ("flt_keyword_any", None), ("dedup_content", "set_union_items")])
def test_some_rows_go_and_some_stay(con, name, whole):
    n = con.execute(f"SELECT count(*) FROM ({E.oracle_sql()[name]})").fetchone()[0]
    total = con.execute("SELECT count(*) FROM " + {"win_daily_quota": "events", None: "documents", "src_newest_per_group": "documents"}.get(
        name, "documents") if whole is None or name == "src_newest_per_group" else f"SELECT count(*) FROM ({E.oracle_sql()[whole]})").fetchone()[0]
    assert 0 < n < total


def test_dashboard_names_every_day_and_sentiment_once(con):
    doubled = con.execute(f"SELECT count(*) FROM (SELECT 1 FROM ({E.oracle_sql()['snk_dashboard_doc']}) WHERE part = 'trend' "
                          "GROUP BY post_date, sentiment_type HAVING count(*) > 1)").fetchone()[0]
    assert doubled == 0
