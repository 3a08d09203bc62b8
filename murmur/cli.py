"""Command line: run the pipeline's jobs over your own tables.

    python -m murmur.cli enrich   --input raw/ --output enriched/ --run 2024-01-16-00 --model model/
    python -m murmur.cli rollup   --input enriched/ --output out/ --kind dual|content|community|company
    python -m murmur.cli dashboard --input enriched/ --output out/ --ticker AAPL --type posts
    python -m murmur.cli search   --input items/ --output out/ --ticker AAPL --timeframe 7d --as-of 1705366800
    python -m murmur.cli ingest   --input items/ --output batch/ --keywords AAPL,TSLA --communities stocks,investing
    python -m murmur.cli extract  --input enriched/ --output training_csv/ --limit 5000
    python -m murmur.cli label    --input training_csv/ --output labeled_csv/
    python -m murmur.cli train    --input labeled_csv/ --output model/
    python -m murmur.cli score    --input training_csv/ --output predictions/ --model model/
    python -m murmur.cli mentions --input items/ --output out/ --keywords AAPL,TSLA --match word
    python -m murmur.cli quota    --input requests/ --output out/ --limit 10
    python -m murmur.cli monitor  --input events/ --output out/

``enrich`` and ``ingest`` add a run to their output: a new run keeps the earlier ones, the same run
again replaces its own rows. ``ingest`` goes on from the mark its earlier runs stored, unless --mark
says otherwise.

Inputs: raw batch JSON (wrapped or bare arrays) for ``enrich``; the day-partitioned enriched
Parquet table (``enrich`` output) or enriched NDJSON for rollups, dashboard and extraction; raw
item JSON / Parquet for ``ingest`` and ``search``; training CSV folders for ``label`` / ``train``.
Run under spark-submit on a cluster (the session comes from the platform; set
``spark.checkpoint.dir`` to a shared folder), or locally with ``--master local[8]``.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from murmur import params as P


def _read_any(spark: SparkSession, path: str, enriched: bool = False) -> DataFrame:
    from murmur.schema import ENRICHED, RAW_ITEM
    if path.rstrip("/").endswith(".json") or "json" in path:
        return spark.read.schema(ENRICHED if enriched else RAW_ITEM).json(path)
    return spark.read.parquet(path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="murmur")
    ap.add_argument("job", choices=["enrich", "rollup", "dashboard", "search", "ingest", "extract", "label", "train", "score",
                                    "mentions", "quota", "monitor"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--kind", default="dual", choices=["dual", "content", "community", "company"])
    ap.add_argument("--ticker", default="ALL")
    ap.add_argument("--aliases", default=None, help="comma list for --kind company")
    ap.add_argument("--type", default="all", choices=list(P.API_ITEM_TYPES))
    ap.add_argument("--timeframe", default="24h")
    ap.add_argument("--as-of", type=float, default=None)
    ap.add_argument("--keywords", default=",".join(P.DEFAULT_KEYWORDS))
    ap.add_argument("--ignore", default="")
    ap.add_argument("--mark", type=float, default=None)
    ap.add_argument("--limit", type=int, default=P.EXTRACT_LIMIT)
    ap.add_argument("--no-relevance", action="store_true")
    ap.add_argument("--run", default=None, help="name of this run (default: the time)")
    ap.add_argument("--model", default=None, help="folder of a trained model")
    ap.add_argument("--communities", default=None, help="comma list, in collection order (ingest, search)")
    ap.add_argument("--match", default="substring", choices=["substring", "word"])
    ap.add_argument("--no-classifier", action="store_true")
    a = ap.parse_args(argv)

    if a.master:
        from murmur.session import build_session
        spark = build_session(master=a.master)
    else:
        from murmur.session import ensure_conf
        spark = ensure_conf(SparkSession.builder.getOrCreate())

    from murmur.operators import aggregations as A
    from murmur.operators import ml as ML
    from murmur.plans import jobs
    from murmur.sources import files, sinks

    run = a.run or time.strftime("%Y-%m-%d-%H-%M-%S", time.gmtime())
    named = tuple(c.strip() for c in a.communities.split(",") if c.strip()) if a.communities else None

    if a.job == "enrich":
        raw = files.read_raw_batches(spark, a.input)
        model = ML.load_model(a.model) if a.model else None
        sinks.write_enriched_table(jobs.job_enrich(raw, classifier_enabled=not a.no_classifier, model=model), a.output, run)
        bad = files.corrupt_batches(spark, a.input)
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{a.output.rstrip('/')}_corrupt/run={run}")
    elif a.job == "rollup":
        e = _read_any(spark, a.input, enriched=True)
        if a.kind == "dual":
            out = A.agg_dual_class(e)
        elif a.kind == "content":
            out = A.agg_content_trends(e)
        elif a.kind == "community":
            out = A.agg_sentiment_by_community(e)
        else:
            aliases = [x.strip() for x in (a.aliases or a.ticker).split(",") if x.strip()]
            out = A.agg_company_combined(e, a.ticker, aliases)
        out.write.mode("overwrite").parquet(a.output)
    elif a.job == "dashboard":
        d = jobs.job_dashboard(_read_any(spark, a.input, enriched=True), P.DashboardParams(a.ticker, a.type))
        jobs.dashboard_doc(d, P.DashboardParams(a.ticker, a.type)).select("doc").write.mode("overwrite").text(a.output)
    elif a.job == "search":
        p = P.SearchParams(ticker=a.ticker, timeframe=a.timeframe, as_of=a.as_of if a.as_of is not None else time.time(),
                           communities=named or tuple(P.SEARCH_SUBREDDITS))
        jobs.search_doc(jobs.job_search(_read_any(spark, a.input), p), p).select("doc").write.mode("overwrite").text(a.output)
    elif a.job == "ingest":
        p = P.IngestParams(keywords=tuple(k for k in a.keywords.split(",") if k),
                           ignore_keywords=tuple(k for k in a.ignore.split(",") if k),
                           mark=a.mark if a.mark is not None else sinks.stored_mark(spark, f"{a.output}/mark", before=run),
                           relevance_check=not a.no_relevance, communities=named or tuple(P.DEFAULT_SUBREDDITS), batch_timestamp=run)
        it = _read_any(spark, a.input)
        r = jobs.job_ingest(it, p)
        if not r.batch.isEmpty():  # the original saves nothing (and keeps its mark) when nothing was collected
            sinks.write_raw_batches(r.batch, f"{a.output}/batch", p.batch_timestamp, p.keywords,
                                    communities=jobs.examined_communities(it, p), run=run)
            r.mark.write.mode("overwrite").parquet(f"{a.output}/mark/run={run}")
        r.funnel.write.mode("overwrite").parquet(f"{a.output}/funnel/run={run}")
    elif a.job == "extract":
        sinks.write_training_csv(jobs.job_extract_training(_read_any(spark, a.input, enriched=True), a.limit), a.output)
    elif a.job == "label":
        t = files.read_training_csv(spark, a.input)
        labeled = jobs.job_label(t, time.strftime("%Y-%m-%d %H:%M", time.gmtime()))
        sinks.write_snapshots(t, labeled.table, a.output, time.strftime("%Y%m%d_%H%M%S", time.gmtime()))
    elif a.job == "train":
        from murmur.operators import filters as flt
        s = ML.ml_split(flt.flt_labeled(files.read_training_csv(spark, a.input), check=True)).persist()
        model, runs = ML.ml_train(s.filter("split = 'train'"), s.filter("split = 'test'"), P.TrainParams(), a.output)
        runs.write.mode("overwrite").parquet(f"{a.output}/runs")
    elif a.job == "score":
        ML.ml_predict(ML.load_model(a.model), files.read_training_csv(spark, a.input)).write.mode("overwrite").parquet(a.output)
    elif a.job == "mentions":
        from murmur.operators import joins as J
        J.join_ticker_mentions(_read_any(spark, a.input), a.keywords.split(","), match=a.match).write.mode("overwrite").parquet(a.output)
    elif a.job == "quota":
        from murmur.operators import windows as WN
        WN.sliding_quota(spark.read.parquet(a.input), "user_id", "ts_s", a.limit).write.mode("overwrite").parquet(a.output)
    elif a.job == "monitor":
        from murmur.operators import monitor as M
        series = M.metric_series(spark.read.parquet(a.input))
        series.write.mode("overwrite").parquet(f"{a.output}/series")
        rules = [(name, name, {"sum": "total_value", "avg": "avg_value"}[s], t, n) for name, s, t, n in P.ALARMS]
        M.alarms(series, rules, P.METRIC_PERIOD_SECONDS).write.mode("overwrite").parquet(f"{a.output}/alarms")


if __name__ == "__main__":
    main()
