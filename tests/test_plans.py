"""Plan assertions: the physical strategies the design relies on."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001


def plan(spark, name):
    df = E.queries()[name](spark, SF0001)
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_newest_per_group_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(spark, "src_newest_per_group")


def test_dedup_content_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(spark, "dedup_content")


def test_top_recent_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_recent")


def formatted(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_prunes_text_and_pushes_filters(spark):
    txt = formatted(E.queries()["agg_dual_class"](spark, SF0001))
    scans = txt.split("Scan parquet")[1:]
    docs = [s for s in scans if "documents.parquet" in s.split("ReadSchema")[0]]
    assert docs, txt
    for s in docs:
        schema = s.split("ReadSchema: ")[1].splitlines()[0]
        assert "text" not in schema.replace("context", ""), schema
    assert "PushedFilters: [IsNotNull(doc_id)]" in txt


@pytest.mark.parametrize("name", ["agg_dual_class", "enr_sentiment", "job_ingest", "agg_filter_funnel", "mon_alarm",
                                  "join_ticker_mentions", "ml_split"])
def test_catalyst_only_queries_have_no_python_nodes(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p, f"{name} has {node}"


def test_mentions_join_nothing(spark):
    """The symbols are a constant array: no join beside those that build the items."""
    p = plan(spark, "join_ticker_mentions")
    assert "NestedLoopJoin" not in p and "Generate explode" in p


def test_no_cartesian_product(spark):
    from murmur.plans import catalog
    catalog.load_all()
    for name in catalog.QUERIES:
        if name.startswith(("ml_", "stm_", "src_", "snk_", "job_train", "job_enrich_model", "agg_best")):
            continue
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p.replace("BroadcastNestedLoopJoin BuildRight, Inner, true", ""), name


def test_ingest_plan_before_its_checkpoint(spark):
    """The accepted posts and their comments as planned, not as reread: pruned scans, no broadcast
    hint, keyword texts bound once."""
    from murmur.plans import fixtures as X, jobs
    from murmur.sources import adapter
    posts_n, linked, _ = jobs.ingest_candidates(adapter.items(spark, SF0001), X.INGEST)
    txt = formatted(posts_n)
    assert "documents.parquet" in txt and "conversations.parquet" in txt and "WindowGroupLimit" in txt
    assert "ResolvedHint" not in linked._jdf.queryExecution().analyzed().toString()
    assert posts_n._jdf.queryExecution().optimizedPlan().toString().count("exists(array(lower(") >= 1


def test_a_large_day_is_written_by_several_tasks(spark, tmp_dir):
    from pyspark.sql import functions as F
    from murmur.sources import sinks
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        day = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("id"), (F.col("id") % 1000 + 1704153600.0).cast("double").alias("created_utc"))
        sinks.write_enriched_table(day, f"{tmp_dir}/day", "r1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = spark.read.parquet(f"{tmp_dir}/day")
    assert back.count() == 60_000 and back.select(F.col("_metadata.file_path")).distinct().count() > 3


def test_many_keywords_cost_little_more_than_one(spark):
    """The text is evaluated once for all keywords."""
    from murmur.operators import filters as flt
    from murmur.sources import adapter
    p = adapter.posts(spark, SF0001).filter(flt.has_keyword([f"nothing{k}" for k in range(31)]))
    text = p._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("lower(") <= 2, text


def test_mark_prunes_day_partitions(spark, tmp_dir):
    from murmur.sources import adapter, files, sinks
    sinks.write_enriched_table(adapter.enriched(spark, SF0001), f"{tmp_dir}/enriched", "r1")
    d = files.read_enriched_table(spark, f"{tmp_dir}/enriched", since=1704153600.0)
    txt = formatted(d.select("id"))
    import re
    assert re.search(r"PartitionFilters: \[isnotnull\(post_date#\d+\), \(post_date#\d+ >= 2024-01-02\)\]", txt), txt
    assert "PushedFilters: [IsNotNull(created_utc), GreaterThanOrEqual(created_utc,1.7041536E9)]" in txt
    all_rows = adapter.items(spark, SF0001).filter("created_utc >= 1704153600.0").count()
    assert d.count() == all_rows


@pytest.mark.parametrize("name", ["agg_dual_class", "agg_sentiment_by_community", "agg_content_trends",
                                  "mon_metric_series"])
def test_rollups_aggregate_partially_before_the_shuffle(spark, name):
    """A hash aggregate sits on both sides of the exchange: each task sends one partial row per
    group, so a hot community or day does not move its rows."""
    txt = formatted(E.queries()[name](spark, SF0001))
    tree = txt.split("\n\n\n")[0]
    lines = [ln.strip(" :+-") for ln in tree.splitlines()]
    i = next(k for k, ln in enumerate(lines) if ln.startswith("Exchange"))
    assert lines[i - 1].startswith("HashAggregate") and lines[i + 1].startswith("HashAggregate"), tree


def test_funnel_reuses_the_window_partitioning(spark):
    """The funnel groups by community right after the newest-per-community window, which already
    hash-partitioned the posts by community: one exchange for the whole query."""
    from murmur.plans import fixtures as X, jobs
    from murmur.sources import adapter
    tree = formatted(jobs.ingest_funnel(adapter.items(spark, SF0001), X.INGEST)).split("\n\n\n")[0]
    shuffles = [ln for ln in tree.splitlines() if "Exchange" in ln and "BroadcastExchange" not in ln]
    assert len(shuffles) == 1, tree
