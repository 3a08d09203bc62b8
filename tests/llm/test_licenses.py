import random
import re
from re import _parser as parser

from murmur.llm import licenses as L
from tests.llm.cases import empty, odd

TEXTS = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0. Apache license", "GNU General Public License, version 3 or later",
         "GNU Lesser General Public License v2.1", "SPDX-License-Identifier: GPL-2.0-only", "CC BY-NC-SA 4.0 and Creative Commons Attribution 3.0 License",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mitlicense amit license licenses",
         "MIT\nlicense MIT license", "Élicense mit élicense", "All rights reserved. Copyright (c) 2019", "no terms here", "license", "mit",
         "general public license general public license", "Mozilla Public License 2.0; Eclipse Public License v2.0", "MIT License " * 40]


def brute(text):
    words = re.findall(L.WORD, (text or "").translate(str.maketrans(L.UPPER, L.LOWER)))
    places, base = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    norm = " " + "  ".join(words) + " " if words else ""
    if not any(g in (text or "").translate(str.maketrans(L.UPPER, L.LOWER)) for g in L.GATE):
        norm = ""
    found = [(m.start(), m.end(), k, r.label) for k, r in enumerate(L.RULES) for m in re.finditer(r.regex, norm) if r.keyword in norm]
    stay = [d for d in found if not any((e[0] <= d[0] and d[1] <= e[1]) and ((e[0], e[1]) != (d[0], d[1]) or e[2] < d[2]) for e in found)]
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d[3] for d in stay})))


def test_rules():
    assert 200 < len(L.RULES) < 600 and all(r.keyword in r.regex for r in L.RULES)


def test_equals_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in L.scan(df).collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == brute(text), text
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
    assert got[3]["labels"] == "gpl,lgpl-2.1" and got[1]["labels"] == "apache,apache-2.0" and got[5]["labels"] == "cc-by-3.0,cc-by-nc-sa-4.0"


def test_odd_rows(spark):
    got = L.scan(odd(spark)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["base_labels"]) for r in got) == sorted(
        (str(r["doc_id"]), brute(r["text"])[0], brute(r["text"])[4]) for r in odd(spark).collect())
    assert L.scan(empty(spark)).count() == 0


def plain(text):
    """All rules over all texts: no gate, no keyword."""
    words = re.findall(L.WORD, text.translate(str.maketrans(L.UPPER, L.LOWER)))
    base = {label for phrase, label in L.BASE.items() if f" {phrase} " in f" {' '.join(words)} "}
    norm = " " + "  ".join(words) + " "
    found = [(m.start(), m.end(), k, r.label) for k, r in enumerate(L.RULES) for m in re.finditer(r.regex, norm)]
    return ",".join(sorted(base | {d[3] for d in found if not any(
        e[0] <= d[0] and d[1] <= e[1] and ((e[0], e[1]) != (d[0], d[1]) or e[2] < d[2]) for e in found)}))


def example(regex, rng):
    """A text that the rule matches."""
    def make(parsed):
        out = ""
        for op, arg in parsed:
            out += (chr(arg) if op is parser.LITERAL else make(arg[3]) if op is parser.SUBPATTERN else make(rng.choice(arg[1])) if op is parser.BRANCH
                    else make([rng.choice(arg)]) if op is parser.IN else chr(rng.randint(*arg)) if op is parser.RANGE
                    else "".join(make(arg[2]) for _ in range(rng.randint(arg[0], arg[1]))))
        return out
    return make(parser.parse(regex))


def test_no_rule_is_lost_before_it_runs(spark):
    rng = random.Random(3)
    texts = ["Files are under MPL-2.0.", "released under\nthe MIT", "CC  BY 4.0", "CC_BY 4.0", "see ZPL 2.1, ODbL 1.0 or Artistic 2.0", "php"]
    texts += [re.sub(" +", lambda _: rng.choice([" ", "\n", "_", " - "]), f"Notes: {example(r.regex, rng)}, and more.") for r in L.RULES for _ in range(2)]
    got = {r["doc_id"]: r["labels"] for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [got[k] for k in range(len(texts))] == [plain(t) for t in texts]
    assert got[0] == "mpl-2.0" and got[1] == "mit" and got[2] == got[3] == "cc-by-4.0" and all(got[k] for k in range(6, len(texts)))
