"""Column expressions over text. All JVM-side built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.params import PY_WHITESPACE, PY_WHITESPACE_CLASS

WS_RUN = PY_WHITESPACE_CLASS + "+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def contains_any(text, words: Iterable[str], match: str = "substring") -> Column:
    """``text`` contains any word. ``substring`` mirrors the original (one-letter symbols match
    almost anything); ``word`` requires word boundaries. Blank words are skipped."""
    words = [w for w in words if w]
    t = col(text)
    if match == "word":
        if not words:
            return F.lit(False)
        import re
        return t.rlike(r"\b(" + "|".join(re.escape(w) for w in words) + r")\b")
    if not words:
        return F.lit(False)
    # the text (often lower(concat(...)) over the whole document) is evaluated once and bound, not once per word
    return F.exists(F.array(t), lambda x: any_of(F.contains(x, F.lit(w)) for w in words))


def py_strip(text) -> Column:
    """Python ``str.strip()``: removes every Unicode whitespace of Python's set at both ends (a trim: a regex
    with an end anchor tries again at every blank of the text)."""
    return F.btrim(col(text), F.lit(PY_WHITESPACE))


def py_collapse(text) -> Column:
    """``' '.join(text.split())``: runs of whitespace become one space, ends trimmed. After the
    collapse only single ASCII spaces are left, so the plain ``trim`` finishes it in one pass."""
    return F.trim(F.regexp_replace(col(text), WS_RUN, " "))


def first(text, n: int | None) -> Column:
    """First ``n`` characters, or the whole text."""
    return col(text) if n is None else F.substring(col(text), 1, n)


def cut(text, n: int, suffix: str | None = None) -> Column:
    """First ``n`` characters (code points); with ``suffix`` appended only when something was cut."""
    t = col(text)
    s = F.substring(t, 1, n)
    if suffix is None:
        return s
    return F.when(F.length(t) > n, F.concat(s, F.lit(suffix))).otherwise(t)


def nonblank(text) -> Column:
    return F.nullif(col(text), F.lit(""))


def epoch_to_day(epoch_seconds) -> Column:
    """UTC day of an epoch-seconds double (session time zone pinned to UTC)."""
    return F.to_date(F.timestamp_seconds(col(epoch_seconds)))


def split_list(s, sep: str = ",") -> Column:
    """Comma list -> trimmed, non-blank items (array)."""
    return F.filter(F.transform(F.split(col(s), sep), py_strip), lambda x: x != "")
