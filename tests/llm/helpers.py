"""Brute-force versions: plain Python over few rows."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate(LOWER)


def shingle_set(text, k):
    w = words(lowered(text))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


class Groups:
    """Union-find over the indexes of a list of sets that link when similar enough."""

    def __init__(self, sets, percent):
        self.up = list(range(len(sets)))
        self.links = 0
        holders = defaultdict(list)
        for i, s in enumerate(sets):
            met = Counter(j for x in s for j in holders[x])
            for j, both in met.items():
                if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                    self.links += 1
                    self.up[self.find(i)] = self.find(j)
            for x in s:
                holders[x].append(i)

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def noisy_copies(rnd, base, copies, most):
    """Copies of a list of words, each with up to ``most`` words replaced."""
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(most + 1)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out
