"""Plain versions of the operators, for small tables."""

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    def __init__(self, n):
        self.at = list(range(n))

    def root(self, a):
        while self.at[a] != a:
            self.at[a] = self.at[self.at[a]]
            a = self.at[a]
        return a

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.at[max(a, b)] = min(a, b)


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(prints, most=4):
    """Root index of each fingerprint."""
    sets, x = Sets(len(prints)), np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in (np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= most) + i + 1).tolist():
            sets.join(i, j)
    return [sets.root(i) for i in range(len(x))]


def removed_words(texts, window=20):
    """Of texts in order: the words and which of them go."""
    seen, out = set(), []
    for t in texts:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            gram = tuple(w[j:j + window])
            if gram in seen:
                gone[j:j + window] = [True] * window
            seen.add(gram)
        out.append((w, gone))
    return out
