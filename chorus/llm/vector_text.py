"""Words and byte strings of whole Arrow batches as numpy hashes, without a Python object per word.

Hashes are 64-bit polynomials over a random value per byte, mixed afterwards;
equal strings always agree, different ones meet with odds of about 2 ** -64.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

AT_ONCE = 1 << 20
_RANDOM = np.random.default_rng(20240229)
_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(2**62, 2**63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, AT_ONCE + 1)

        def powers(of: int) -> np.ndarray:
            out = np.full(size, of, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        _powers, _inverses = powers(_BASE), powers(_INVERSE)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64))


@dataclass
class Texts:
    """Some whole texts end to end: text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def prefix_hashes(self, lower: bool = False) -> np.ndarray:
        n = len(self.data)
        powers, _ = _grown(n)
        values = (_VALUES[_LOWER] if lower else _VALUES)[self.data]
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:n], out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """Hash of every byte range, whatever its place."""
        _, inverses = _grown(len(self.data))
        return mix((prefix[ends] - prefix[starts]) * inverses[starts])

    def spans(self, gaps: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and per text the number of words before it; ``gaps`` marks bytes between words."""
        n = len(self.data)
        inside = ~gaps[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def words(self, gaps: np.ndarray = IS_SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, by default with A to Z lowered, and per text the number of words before it."""
        starts, ends, counts = self.spans(gaps)
        return self.hashes(starts, ends, self.prefix_hashes(lower=lower)), counts


def texts(column: pa.Array, at_once: int = AT_ONCE) -> Iterator[Texts]:
    """The texts of an Arrow string column in groups of whole texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, places, held = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + at_once, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Texts(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside one text, with the number of the text.

    A text of fewer words, but at least one, has the whole as its only run.
    """
    n = np.diff(counts)
    total = len(words)
    rolled = np.zeros(max(0, total - k + 1), np.uint64)
    for j in range(k):
        rolled = rolled * np.uint64(_BASE) + words[j:j + len(rolled)]
    per = np.maximum(n - k + 1, 0)
    owner = np.repeat(np.arange(len(n)), per)
    starts = np.repeat(counts[:-1], per) + _ranges(per)
    out = mix(rolled[starts])
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            here = n[short] > j
            at = np.where(here, counts[short] + j, 0)
            whole = np.where(here, whole * np.uint64(_BASE) + words[at], whole)
        out = np.concatenate([out, salted(whole, k)])
        owner = np.concatenate([owner, short])
    return out, owner


def shingle_sets(group: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted, end to end, and per text the number before it."""
    words, counts = group.words()
    values, owner = shingles(words, counts, k)
    n = np.diff(counts)
    if ((n > 0) & (n < k)).any():
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(group) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    before = np.concatenate([[0], np.cumsum(new)])
    return values[new], before[bounds]


def _ranges(per: np.ndarray) -> np.ndarray:
    """0, 1, ... per[0] - 1, 0, 1, ... per[1] - 1, and so on."""
    ends = np.cumsum(per)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - per, per)


def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per owner, sorted by owner, then value."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]
