"""Window logic the original runs as loops: per-group top-N, comment caps, the collection budget
and request quotas."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import params as P


def newest_first() -> list[Column]:
    return [F.col("created_utc").desc(), F.col("id")]


def newest_per_group(df: DataFrame, key: str = "subreddit", n: int | None = P.INGEST_POST_LIMIT,
                     order: list[Column] | None = None) -> DataFrame:
    """The newest ``n`` rows per group (None: all). ``row_number() <= n`` plans as a WindowGroupLimit,
    which also runs before the shuffle, so a hot group ships at most ``n`` rows per map task."""
    if n is None:
        return df
    w = W.partitionBy(key).orderBy(*(order or newest_first()))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def comment_cap(comments: DataFrame, n: int = P.SEARCH_COMMENTS_PER_POST) -> DataFrame:
    """First ``n`` comments per post in listing order (oldest first); the quality filter runs
    after this cap, as in the original."""
    w = W.partitionBy("post_id").orderBy(F.col("created_utc"), F.col("id"))
    return (comments.withColumn("comment_rank", F.row_number().over(w))
            .filter(F.col("comment_rank") <= n))


def item_budget(posts: DataFrame, budget: int | None, community_rank: Column | None = None) -> DataFrame:
    """Keep posts (in collection order: community order, then newest first) while the items
    collected *before* each post are under the budget; the last kept post may overshoot with its
    comments. ``posts`` carries ``n_items`` = 1 + its kept comments; no budget keeps all.

    Every post counts at least one item, so only the first ``budget`` posts in collection order
    can be kept: the global limit (a top-k per task, then a merge) is exact, and the running sum
    sees at most ``budget`` rows however many posts there are."""
    if budget is None:
        return posts
    rank = community_rank if community_rank is not None else F.lit(0)
    order = [F.col("_crank"), F.col("subreddit"), *newest_first()]
    first = posts.withColumn("_crank", rank).orderBy(*order).limit(budget)
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (first.withColumn("items_before", F.coalesce(F.sum("n_items").over(before), F.lit(0)))
            .filter(F.col("items_before") < budget).drop("_crank"))


def daily_quota(requests: DataFrame, key: str, ts: str, quota: int = P.DAILY_QUOTA) -> DataFrame:
    """First ``quota`` requests per key and UTC day (WindowGroupLimit, so a hot key is cut to
    ``quota`` rows per map task before the shuffle)."""
    day = F.to_date(F.col(ts))
    w = W.partitionBy(F.col(key), day).orderBy(F.col(ts), F.col("event_id"))
    return (requests.withColumn("request_no", F.row_number().over(w))
            .filter(F.col("request_no") <= quota).withColumn("day", day))


def quota_segment(carried: list, ts: np.ndarray, limit: int, window_s: float) -> tuple[np.ndarray, list]:
    """Accept flags for one client's requests ``ts`` (sorted), given the accepted timestamps
    ``carried`` from earlier rows; returns (flags, accepted timestamps still in the window).

    Fast path (vectorised): when no ``limit + 1`` requests fall inside one window, i.e.
    ts[i] - ts[i - limit] >= window for the carried + new sequence, every request is accepted.
    Only clients that really overflow walk their rows one by one."""
    seq = np.concatenate([np.asarray(carried, dtype="float64"), ts])
    if len(seq) <= limit or bool(np.all(seq[limit:] - seq[:-limit] >= window_s)):
        acc = np.ones(len(ts), dtype=bool)
        kept = seq[seq > seq[-1] - window_s][-limit:] if len(seq) else seq
        return acc, [float(x) for x in kept]
    kept = deque(float(x) for x in carried)
    acc = np.zeros(len(ts), dtype=bool)
    i, n = 0, len(ts)
    while i < n:  # one turn per accepted request: a full window jumps to the first time that can be accepted
        t = float(ts[i])
        while kept and not (kept[0] > t - window_s):
            kept.popleft()
        if len(kept) < limit:
            kept.append(t)
            acc[i] = True
            i += 1
        else:
            due = np.nextafter(np.nextafter(kept[0] + window_s, -np.inf), -np.inf)  # rounding of t - window_s
            i = max(i + 1, int(np.searchsorted(ts, due, side="left")))
    return acc, list(kept)


def _quota_partitions(limit: int, window_s: float, keys: list[str], ts: str):
    """mapInPandas body: rows arrive sorted by (keys, ts); each batch is cut into segments of equal
    keys, and the accepted timestamps of the current segment (at most ``limit``) carry over to
    the next batch."""
    def run(batches):
        cur, carried = None, []
        for pdf in batches:
            if pdf.empty:
                continue
            kv = [pdf[k].to_numpy() for k in keys]
            tss = pdf[ts].to_numpy(dtype="float64")
            acc = np.zeros(len(pdf), dtype=bool)
            change = np.zeros(len(pdf) - 1, dtype=bool)
            for v in kv:
                change |= v[1:] != v[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(pdf)]])
            for a, b in zip(starts[:-1], starts[1:]):
                k = tuple(v[a] for v in kv)
                if k != cur:
                    cur, carried = k, []
                acc[a:b], carried = quota_segment(carried, tss[a:b], limit, window_s)
            yield pdf.assign(accepted=acc)
    return run


#: Requests of one block, the unit that a task works on; time slots of a window from which blocks are cut.
QUOTA_BLOCK_ROWS, QUOTA_SLOTS = 1 << 18, 1024


def _quota_slots(requests: DataFrame, key: str, ts: str, window_s: float, block_rows: int) -> DataFrame:
    """(key, _slot, _seg, _block, _last): where each slot of a client's timeline belongs. A segment ends
    where a whole window is empty, a block where it has about ``block_rows`` requests. Counts per
    (client, slot) are a partial aggregate; the windows see a row per slot of a client, which the time
    range bounds, not the traffic."""
    slots = requests.withColumn("_slot", _slot(ts, window_s)).groupBy(key, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    timeline, bucket = W.partitionBy(key).orderBy("_slot"), F.floor(F.col("_slot") / QUOTA_SLOTS)
    gap = F.coalesce((bucket - F.lag(bucket).over(timeline) > 1).cast("int"), F.lit(0))
    own = W.partitionBy(key, "_seg")
    before = F.sum("_n").over(own.orderBy("_slot")) - F.col("_n")
    return (slots.withColumn("_gap", gap).withColumn("_seg", F.sum("_gap").over(timeline))
            .withColumn("_block", F.floor(before / block_rows)).withColumn("_last", F.max("_block").over(own)).drop("_n", "_gap"))


def _slot(ts: str, window_s: float) -> Column:
    return F.floor(F.col(ts) / F.lit(float(window_s) / QUOTA_SLOTS)).cast("bigint")


def quota_segments(requests: DataFrame, key: str, ts: str, window_s: float, block_rows: int = QUOTA_BLOCK_ROWS) -> DataFrame:
    """``requests`` with ``_seg`` and ``_block``. Nothing accepted before an empty window can be inside
    any later request's window, so segments are independent; blocks of one are in order."""
    slots = _quota_slots(requests, key, ts, window_s, block_rows)
    return requests.withColumn("_slot", _slot(ts, window_s)).join(slots, [key, "_slot"]).drop("_slot", "_last")


def quota_exit(carried: list | None, ts: np.ndarray, limit: int, window_s: float) -> list | None:
    """A block's map from entry state to exit state (accepted times still in the window of the block's
    last request). Where any ``limit + 1`` requests in a row span two windows, every state lets the last
    window's requests through: from the last such place on the exit is known whatever the entry
    (``carried`` None: only then is there an exit)."""
    sparse = np.flatnonzero(ts[limit:] - ts[:-limit] >= 2 * window_s) if len(ts) > limit else np.zeros(0, int)
    if len(sparse):
        at = int(sparse[-1]) + limit
        alive = ts[:at + 1][ts[:at + 1] > ts[at] - window_s]
        return quota_segment([float(x) for x in alive], ts[at + 1:], limit, window_s)[1]
    return None if carried is None else quota_segment(carried, ts, limit, window_s)[1]


def _known_exits(limit: int, window_s: float):
    """mapInPandas body over packed blocks: a block whose exit is known no longer needs its times."""
    def run(batches):
        for pdf in batches:
            exits = [quota_exit(None, np.asarray(t, dtype="float64"), limit, window_s) for t in pdf["_times"]]
            yield pdf.assign(_exit=exits, _times=[t if e is None else None for t, e in zip(pdf["_times"], exits)])
    return run


def _block_entries(limit: int, window_s: float, keys: list[str]):
    """mapInPandas body over a segment's packed blocks in order: composes their maps and gives, for each
    block, the accepted times it starts with (one row each)."""
    def run(batches):
        cur, state = None, []
        for pdf in batches:
            rows = []
            for *k, block, times, known in pdf[[*keys, "_block", "_times", "_exit"]].itertuples(index=False):
                if tuple(k) != cur:
                    cur, state = tuple(k), []
                rows += [(*k, block, t) for t in state]
                state = list(known) if times is None else quota_exit(state, np.asarray(times, dtype="float64"), limit, window_s)
            yield pd.DataFrame(rows, columns=[*keys, "_block", "_ts"])
    return run


def quota_entries(requests: DataFrame, key: str, ts: str, limit: int, window_s: float, block_rows: int = QUOTA_BLOCK_ROWS) -> DataFrame:
    """(key, _seg, _block, _ts): the accepted times with which each block of a segment of several blocks
    starts. Blocks are sorted and packed in parallel; the step from block to block reads only the
    packed times of blocks whose exit is not known yet, and binary-searches them from one accepted
    request to the next."""
    several = _quota_slots(requests, key, ts, window_s, block_rows).filter(F.col("_last") > 0)
    rows = requests.select(key, ts, _slot(ts, window_s).alias("_slot")).join(several, [key, "_slot"])
    packed = rows.groupBy(key, "_seg", "_block").agg(F.sort_array(F.collect_list(ts)).alias("_times"))
    kind = requests.schema[key].dataType.simpleString()
    at = f"{key} {kind}, _seg bigint, _block bigint"
    maps = packed.mapInPandas(_known_exits(limit, window_s), f"{at}, _times array<double>, _exit array<double>")
    ordered = maps.repartition(key, "_seg").sortWithinPartitions(key, "_seg", "_block")
    return ordered.mapInPandas(_block_entries(limit, window_s, [key, "_seg"]), f"{at}, _ts double")


def sliding_quota(requests: DataFrame, key: str = "user_id", ts: str = "ts_s",
                  limit: int = P.SEARCH_QUOTA_PER_HOUR, window_s: float = 3600.0, block_rows: int = QUOTA_BLOCK_ROWS) -> DataFrame:
    """At most ``limit`` accepted requests per key in any trailing ``window_s`` seconds; refused
    requests do not count. Accepted-only state makes a RANGE frame insufficient, so this is a parallel
    scan of the per-key state machine: a client's timeline is cut into blocks (``quota_segments``), the
    blocks' maps from entry to exit state are composed (``quota_entries``), and each block fills its
    flags on its own, starting with its entry state's times as requests that are accepted again. A
    burst of one client is as many tasks as it has blocks; a client of one block needs no composition."""
    rows = quota_segments(requests, key, ts, window_s, block_rows)
    carried = quota_entries(requests, key, ts, limit, window_s, block_rows).withColumnRenamed("_ts", ts)
    both = rows.withColumn("_new", F.lit(True)).unionByName(carried.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    ordered = both.repartition(key, "_seg", "_block").sortWithinPartitions(key, "_seg", "_block", ts, "event_id")
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in both.schema.fields]) + ", accepted boolean"
    out = ordered.mapInPandas(_quota_partitions(limit, window_s, [key, "_seg", "_block"], ts), schema)
    return out.filter("_new").drop("_seg", "_block", "_new")


def quota_reference(rows: list[tuple], limit: int, window_s: float = 3600.0) -> list[bool]:
    """Brute-force rule for tests: rows = [(key, ts)] in arrival order."""
    state: dict = {}
    out = []
    for k, t in rows:
        kept = [x for x in state.get(k, []) if x > t - window_s]
        ok = len(kept) < limit
        if ok:
            kept.append(t)
        state[k] = kept
        out.append(ok)
    return out

