import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm._words import RangeHash, find_words, hash_words, pieces

TEXT = st.lists(st.sampled_from([*"ab é\n\t\x0b日", "longword" * 5, "z" * 300]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_are_those_of_the_pattern_in_every_text(texts):
    got = []
    for lo, hi, offsets, data in pieces(pa.array(texts, pa.string()), limit=20):
        w = find_words(offsets, data)
        raw = data.tobytes()
        h = hash_words(data, w.starts, w.ends)
        words = [raw[a:z].decode() for a, z in zip(w.starts, w.ends)]
        assert len({*zip(words, h.tolist())}) == len(set(words)) == len(set(h.tolist()))
        got += [words[a:z] for a, z in zip(w.first[:-1], w.first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_range_hash_depends_on_content_only():
    h = np.array([5, 7, 9, 5, 7, 9, 5, 8], np.uint64)
    r = RangeHash(h)
    of = lambda i, j: int(r.of(np.array([i]), np.array([j]))[0])
    assert of(0, 3) == of(3, 6) and of(0, 2) == of(3, 5) and of(0, 3) != of(1, 4) and of(5, 7) != of(6, 8)
