"""License scan by ordered signature rules; DataFrame operations only.

A text becomes its words in lower case, each between two blanks. Rules (regex, label, keyword) are
ordered. A rule runs only where its keyword and then its longest fixed part occur in the words: every
match holds both, so neither loses one. Detections are character intervals: one that lies inside another goes,
and of equal intervals the first rule stays. Interval work is one sorted scan per text.

Cases: a null or empty text has no words, no places and no labels (empty strings, score 0); every
row gives one row, repeated rows too; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Rules are written with single blanks between words; (...)? with a leading blank is optional.
CC_ELEMENTS = {"by": "attribution", "by sa": "attribution share ?alike", "by nc": "attribution non ?commercial",
               "by nd": "attribution no ?deriv(ative)?s?", "by nc sa": "attribution non ?commercial share ?alike",
               "by nc nd": "attribution non ?commercial no ?deriv(ative)?s?"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
GNU = {"gpl": "general public", "lgpl": "(lesser|library) general public", "agpl": "affero general public", "fdl": "free documentation"}
GNU_VERSIONS = {"gpl": ("1", "2", "3"), "lgpl": ("2", "2 1", "3"), "agpl": ("1", "3"), "fdl": ("1 1", "1 2", "1 3")}
#: label -> (name as words, versions)
NAMED = {
    "apache": ("apache", ("1 0", "1 1", "2 0")), "mpl": ("mozilla public", ("1 0", "1 1", "2 0")), "epl": ("eclipse public", ("1 0", "2 0")),
    "cddl": ("common development and distribution", ("1 0", "1 1")), "eupl": ("european union public", ("1 0", "1 1", "1 2")),
    "ofl": ("(sil )?open font", ("1 0", "1 1")), "afl": ("academic free", ("1 1", "1 2", "2 0", "2 1", "3 0")), "osl": ("open software", ("1 0", "1 1", "2 0", "2 1", "3 0")),
    "cpl": ("common public", ("1 0",)), "ipl": ("ibm public", ("1 0",)), "lppl": ("latex project public", ("1 0", "1 1", "1 2", "1 3")),
    "artistic": ("artistic", ("1 0", "2 0")), "bsl": ("boost software", ("1 0",)), "php": ("php", ("3 0", "3 01")), "psf": ("python software foundation", ("2",)),
    "zpl": ("zope public", ("1 1", "2 0", "2 1")), "ecl": ("educational community", ("1 0", "2 0")), "odbl": ("open database", ("1 0",)),
    "ms-pl": ("microsoft public", ("1 0",)), "ms-rl": ("microsoft reciprocal", ("1 0",)), "sspl": ("server side public", ("1",)), "busl": ("business source", ("1 1",)),
}
PLAIN_SPDX = ("mit", "mit 0", "isc", "0bsd", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "zlib", "unlicense", "wtfpl", "x11", "ncsa", "postgresql", "cc0 1 0", "curl", "beerware")
#: (label, keyword, regex, confidence): texts and names that follow no scheme.
SINGLE = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy( of this software)?", 1.0),
    ("isc", "purpose", "permission to use copy modify and or distribute this software for any purpose with or without fee", 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms( with or without modification)?( are permitted)?", 1.0),
    ("zlib", "express", "this software is provided as is without any express or implied warranty", 0.9),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("wtfpl", "fuck", "do what the fuck you want to public license", 1.0),
    ("warranty-disclaimer", "warrant", "without warranty of any kind( express or implied)?", 0.5),
    ("warranty-disclaimer", "warrant", "without even the implied warranty of merchantability( or fitness for a particular purpose)?", 0.6),
    ("mit", "mit", "(released|licensed|distributed|available) under( the)?( terms of the)? mit( license)?", 0.9),
    ("mit", "expat", "expat license", 0.8), ("x11", "x11", "x11 license", 0.8), ("isc", "isc", "isc license", 0.8),
    ("zlib", "zlib", "zlib( libpng)? license", 0.8), ("ncsa", "ncsa", "university of illinois ncsa open source license", 0.9),
    ("bsd-2-clause", "bsd", "(bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)( license)?", 0.9),
    ("bsd-3-clause", "bsd", "(bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)( license)?", 0.9),
    ("bsd-4-clause", "bsd", "(bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)( license)?", 0.9),
    ("bsd", "bsd", "bsd( style)? licen[sc]e", 0.7), ("cc0", "cc0", "cc0( 1 0)?( universal)?", 0.8),
    ("public-domain", "domain", "(dedicated|released|placed)( in)?( to)?( into)? the public domain", 0.8),
    ("public-domain", "domain", "public domain( mark)?", 0.4),
    ("all-rights-reserved", "reserved", "all rights reserved", 0.4),
    ("proprietary", "proprietary", "proprietary and confidential", 0.7), ("proprietary", "proprietary", "proprietary licen[sc]e", 0.7),
    ("copyright", "copyright", "copyright( c)? (19|20)[0-9][0-9]", 0.3),
    ("creative-commons", "commons", "creative commons( public)? licen[sc]e", 0.6),
    ("unknown-license", "licen", "licen[sc]ed under( the)?( terms of)?( the)?", 0.2),
    ("unknown-license", "licen", "see( the)? licen[sc]e( file)?( for details)?", 0.2),
)

@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    regex: str  # over the text with each word between two blanks
    confidence: float

    @property
    def fixed(self) -> str:
        """The longest text that every match holds: groups, sets and what may be absent are cut out."""
        rest, n = self.regex, 1
        while n:
            rest, n = re.subn(r"\([^()]*\)\??", "\0", rest)
        return max(re.split(r"\0|\[[^]]*\]|.\?", rest), key=len)


def _rule(label: str, keyword: str, words: str, confidence: float) -> Rule:
    return Rule(label, keyword, f" {words.replace(' ?', '@').replace(' ', '  ').replace('@', '( {2})?')} ", confidence)


def _dash(version: str) -> str:
    return version.replace(" ", ".")


def build_rules() -> list[Rule]:
    """In order of priority: identifiers, versioned names, names and texts, vague phrases."""
    out: list[Rule] = []
    spdx = "spdx license identifier "
    for e, name in CC_ELEMENTS.items():
        for v in CC_VERSIONS:
            label = f"cc-{e.replace(' ', '-')}-{_dash(v)}"
            out += [_rule(label, "spdx", f"{spdx}cc {e} {v}", 1.0),
                    _rule(label, "creative", f"creative commons {name}( {v}|( version)? {v})( international| unported| generic)?( licen[sc]e)?", 1.0),
                    _rule(label, "cc", f"(licensed under )?cc {e} {v}", 0.9)]
    for short, name in GNU.items():
        for v in GNU_VERSIONS[short]:
            tail = "" if " " in v or v == "1" else "( 0)?"
            label = f"{short}-{_dash(v) if ' ' in v else v + '.0'}"
            out += [_rule(label, "spdx", f"{spdx}{short} {v}{tail}( only| or later)?", 1.0),
                    _rule(label, short, f"{short}( version| v)? ?v?{v}{tail}( only| or later)?", 0.9),
                    _rule(label, "gnu", f"(licensed under the )?gnu {name} licen[sc]e( as published by the free software foundation)?( either)?"
                                        f"( version| v)? ?v?{v}{tail}( of the license)?( only| or later| or any later version)?", 1.0)]
    for label, (name, versions) in NAMED.items():
        key = name.rpartition(" ")[2]
        for v in versions:
            out += [_rule(f"{label}-{_dash(v)}", "spdx", f"{spdx}{label.replace('-', ' ')} {v}", 1.0),
                    _rule(f"{label}-{_dash(v)}", key, f"(licensed under the )?{name} licen[sc]e( agreement)?( version| v)? ?v?{v}", 1.0),
                    _rule(f"{label}-{_dash(v)}", label.partition("-")[0], f"{label.replace('-', ' ')}( version| v)? ?v?{v}", 0.7)]
    out += [_rule(x.replace(" ", "-"), "spdx", f"{spdx}{x}", 1.0) for x in PLAIN_SPDX]
    out += [_rule(short, "gnu", f"gnu {name} licen[sc]e", 0.9) for short, name in GNU.items()]
    out += [_rule(label, name.rpartition(" ")[2], f"{name} licen[sc]e", 0.8) for label, (name, _) in NAMED.items()]
    return out + [_rule(*s) for s in SINGLE]


RULES = build_rules()

#: The rules' own keywords: a text without any of these has no detection. A keyword is part of one word,
#: so it occurs in the text in lower case if and only if it occurs in the words.
GATE = tuple(sorted({r.keyword for r in RULES}))


def _groups(rules: list[Rule]) -> Column:
    """Rules by keyword, as a constant array."""
    by: dict[str, list[Column]] = {}
    for i, r in enumerate(rules):
        by.setdefault(r.keyword, []).append(F.struct(F.lit(i).alias("prio"), F.lit(r.label).alias("label"), F.lit(r.regex).alias("rx"), F.lit(r.fixed).alias("fixed"),
                                                     F.lit(r.confidence).alias("confidence")))
    return F.array(*(F.struct(F.lit(k).alias("keyword"), F.array(*v).alias("rules")) for k, v in by.items()))


_SPANS = """transform(hits, r -> aggregate(r.m,
  named_struct('i', 0, 'at', 0, 'out', cast(array() AS array<struct<begin:int,back:int,prio:int,label:string,confidence:double>>)),
  (a, x) -> named_struct('i', a.i + 1, 'at', a.at + length(r.p[a.i]) + length(x), 'out', concat(a.out, array(named_struct(
    'begin', a.at + length(r.p[a.i]), 'back', -(a.at + length(r.p[a.i]) + length(x)), 'prio', r.prio, 'label', r.label, 'confidence', r.confidence)))),
  a -> a.out))"""

# sorted by begin, then the longest, then the first rule: what ends no later than one seen before lies inside it
_SCAN = """aggregate(array_sort(flatten(spans)),
  named_struct('upto', 0, 'labels', cast(array() AS array<string>), 'doubt', cast(1.0 AS double)),
  (a, d) -> if(-d.back <= a.upto, a, named_struct('upto', -d.back, 'labels', array_union(a.labels, array(d.label)), 'doubt', a.doubt * (1 - d.confidence / 2))))"""

_PLACES = """filter(sequence(0, size(words) - 2), i -> words[i + 1] = 'license' AND (words[i] = 'mit' OR words[i] = 'apache')
  OR words[i] = 'general' AND words[i + 1] = 'public' AND get(words, i + 2) = 'license')"""


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    nothing = "cast(NULL AS array<int>)"
    base = [F.expr(f"if(exists(places, i -> words[i] = '{phrase.split()[0]}'), '{label}', NULL)")
            for phrase, label in sorted(BASE.items(), key=lambda x: x[1])]
    rows = (docs.select(F.col(id_col).alias("id"), low.alias("low"))
            .select("id", "low", F.regexp_extract_all("low", F.lit(WORD), 0).alias("words"))
            .withColumn("places", F.expr(f"if(contains(low, 'license') AND size(words) > 1, {_PLACES}, {nothing})"))
            .withColumn("norm", F.when(F.size("words") > 0, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))))
            .withColumn("base", F.array_compact(F.array(*base))))
    detected = (rows.withColumn("groups", F.when(F.col("norm").isNotNull(), _groups(rules or RULES)))
                .withColumn("hits", F.expr("flatten(transform(filter(groups, g -> contains(norm, g.keyword)), g -> filter(g.rules, r -> contains(norm, r.fixed) AND norm RLIKE r.rx)))"))
                .withColumn("hits", F.expr("transform(hits, r -> struct(r.prio AS prio, r.label AS label, r.confidence AS confidence, regexp_extract_all(norm, r.rx, 0) AS m, split(norm, r.rx, -1) AS p))"))
                .withColumn("spans", F.expr(_SPANS))
                .withColumn("found", F.expr(_SCAN)))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found.labels", F.array().cast("array<string>")))))
    n = F.coalesce(F.size("places"), F.lit(0))
    some = F.col("n_base") > 0
    return (detected.withColumn("n_base", F.when(n > 0, n).otherwise(0).cast("long"))
            .select(F.col("id").alias(id_col), F.size("words").cast("long").alias("n_words"), "n_base",
                    F.when(some, F.get("places", F.lit(0))).cast("long").alias("first_word"),
                    F.when(some, F.element_at("places", -1)).cast("long").alias("last_word"),
                    F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                    F.round(1 - F.coalesce("found.doubt", F.lit(1.0)) * F.when(some, 0.1).otherwise(1.0), 9).alias("score")))
