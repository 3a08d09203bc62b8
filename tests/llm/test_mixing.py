from murmur.llm import mixing
from tests.llm.cases import SCHEMA, empty, odd, rows


def brute(docs):
    """(id, source) -> (size, target, taken) by sorting; docs: (id, text, source)."""
    import hashlib
    import re
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:12], 16))
             for i, t, s in docs]
    names = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {n: sum(k for _, s, k, _ in sized if s == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        rest = sum(weight[n] for n in names if n not in full)
        level = (total - sum(2.0 * size[n] for n in full)) / rest if rest else 0.0
        more = {n for n in names if n not in full and 2 * size[n] <= level * weight[n]}
        if not more:
            break
        full |= more
    target = {n: 2.0 * size[n] if n in full else min(2.0 * size[n], level * weight[n]) for n in names}
    taken = {}
    for n in names:
        whole = int(target[n] // size[n]) if size[n] else 0
        rest, upto, cut = target[n] - whole * size[n], 0, -1
        for h in sorted({h for _, s, k, h in sized if s == n and k}):
            step = sum(k for _, s, k, g in sized if s == n and g == h)
            if upto + step > rest:
                cut = h if upto + step - rest < rest - upto else cut
                break
            upto, cut = upto + step, h
        for i, s, k, h in sized:
            if s == n:
                taken[i, s] = (k, target[n], (whole + (h <= cut)) * k)
    return taken


def test_takes_what_sorting_by_hash_takes(spark):
    docs = [(i, " ".join(["w"] * (i * 37 % 90)), f"s{i % 7}" if i % 7 else None) for i in range(300)]
    docs += [(300 + i, " ".join(["w"] * 40), "big") for i in range(300)]  # a third of all rows and more
    got = mixing.mix(spark.createDataFrame(rows(docs), SCHEMA).repartition(4)).collect()
    source = {i: s for i, _, s in docs}
    assert {(r["doc_id"], source[r["doc_id"]]): (r["size"], r["target"], r["taken"]) for r in got} == brute(docs)
    assert sum({(r["source_size"], r["target"]) for r in got} and {source[r["doc_id"]]: r["target"] for r in got}.values()) - 1.5 * sum(r["size"] for r in got) < 1e-6
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_odd_rows(spark):
    got = mixing.mix(odd(spark)).collect()
    assert len(got) == 15 and all(r["taken"] == 0 for r in got if r["size"] == 0)
    twice = [r["taken"] for r in got if r["doc_id"] == 2]
    assert twice[0] == twice[1]
    assert mixing.mix(empty(spark)).count() == 0


def test_mixed_repeats_rows(spark):
    df = odd(spark)
    out = mixing.mixed(df)
    assert out.schema == df.schema and mixing.mixed(empty(spark)).count() == 0
    sizes = {"taken": sum(r["taken"] for r in mixing.mix(df).collect()),
             "rows": sum(len((r["text"] or "").split()) for r in out.collect())}
    assert sizes["taken"] == sizes["rows"]
