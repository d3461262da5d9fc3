"""BPE encoding and decoding: a segment tree over adjacent pair ranks drives the merges.

Each leaf of a word's tree holds ``rank * width + place`` of an adjacent pair,
so the root is the leftmost pair of lowest rank. A merge changes three leaves,
each followed to the root. Words of one width stand in one matrix, a forest of
trees that numpy advances together. Pieces between white space are remembered
per worker, by hash, in a table of bounded size.
"""

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorus.llm.common import fresh, small_batches
from chorus.llm.vector_text import Texts, texts

REMEMBERED = 1_500_000
#: What a vocabulary pattern means by white space; Python adds U+001C to U+001F.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
NONE = np.iinfo(np.int64).max


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class Encoder:
    """A tokenizer file of lower-cased words with word ends, as ids and back."""

    def __init__(self, text: str):
        given = json.loads(text)
        model, steps = given["model"], given["pre_tokenizer"]["pretokenizers"]
        kinds = [s["type"] for s in given["normalizer"]["normalizers"]] + [s["type"] for s in steps]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            raise ValueError(f"unsupported tokenizer: {model['type']}, {kinds}")
        vocab, letters, end = model["vocab"], _byte_letters(), model["end_of_word_suffix"]
        self.special = {t["content"].encode(): t["id"] for t in given["added_tokens"]}
        every = vocab | {t["content"]: t["id"] for t in given["added_tokens"]}
        named = {i: t for t, i in every.items()}
        self.strings = pa.array([named.get(i, "") for i in range(max(named) + 1)])
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        self.base = np.int64(len(vocab) + 1)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"].replace("\\s", SPACE))
        self.marks = re.compile(b"|".join(map(re.escape, self.special))) if self.special else None
        self._forget()

    # -- merging

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merged(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Token ids of every word (never empty), in order."""
        out: list = [None] * len(words)
        size = np.array([len(w) for w in words])
        done, width = np.zeros(len(words), bool), 2
        while not done.all():
            mine = np.flatnonzero(~done & (size <= width))
            done[mine] = True
            for part in np.array_split(mine, max(1, len(mine) * width // 250_000)):
                if len(part):
                    for i, ids in zip(part, self._forest([words[k] for k in part], size[part], width), strict=True):
                        out[i] = ids
            width *= 2
        return out

    def _forest(self, words: list[bytes], size: np.ndarray, width: int) -> Iterator[tuple[int, ...]]:
        n, rows = len(words), np.arange(len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        symbol = self.inner[raw]
        symbol[rows, size - 1] = self.last[raw[rows, size - 1]]
        place = np.arange(width)
        after = np.where(place + 1 < size[:, None], place + 1, width).astype(np.int32)
        before = np.broadcast_to(np.arange(-1, width - 1, dtype=np.int32), (n, width)).copy()
        alive = place < size[:, None]
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self._rank(symbol[:, :-1], symbol[:, 1:])
        rank[place[1:] >= size[:, None]] = NONE
        tree[:, width:-1] = np.where(rank == NONE, NONE, rank * width + place[:-1])
        level = width // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2

        def put(who: np.ndarray, leaf: np.ndarray, key: np.ndarray) -> None:
            node = leaf + width
            tree[who, node] = key
            while (node := node >> 1)[0]:
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])

        def key_of(who: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self._rank(symbol[who, left], symbol[who, right])
            return np.where(rank == NONE, NONE, rank * width + left)

        who = rows[tree[:, 1] != NONE]
        while len(who):
            root = tree[who, 1]
            at, gone = root % width, after[who, root % width]
            symbol[who, at] = self.made[root // width]
            alive[who, gone] = False
            beyond = after[who, gone]
            after[who, at] = beyond
            put(who, gone, np.full(len(who), NONE))
            has = beyond < width
            before[who[has], beyond[has]] = at[has]
            key = np.full(len(who), NONE)
            key[has] = key_of(who[has], at[has], beyond[has])
            put(who, at, key)
            ahead = before[who, at]
            has = ahead >= 0
            if has.any():
                put(who[has], ahead[has], key_of(who[has], ahead[has], at[has]))
            who = who[tree[who, 1] != NONE]
        left = alive.sum(1)
        flat, ends = symbol[alive].tolist(), np.cumsum(left).tolist()
        start = 0
        for end in ends:
            yield tuple(flat[start:end])
            start = end

    # -- texts

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Remember the ids of pieces not seen before."""
        parts = []
        for p in pieces:
            if p.isascii():
                p = p.lower()
                parts.append([p] if p.isalpha() else self.pattern.findall(p))
            else:
                # case is folded sign by sign, so a final sigma is an ordinary one
                p = unicodedata.normalize("NFC", p).replace("Σ", "σ").lower()
                parts.append(self.pattern.findall(p))
        words = list(dict.fromkeys(chain.from_iterable(parts)))
        ids = dict(zip(words, self.merged([w.encode() for w in words]), strict=True)) if words else {}
        found = [ids[w[0]] if len(w) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, w))) for w in parts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _forget(self) -> None:
        self.known, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, group: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and per text the number of ids before it.

        Strings of special tokens inside a text become those tokens.
        """
        if len(self.known) > REMEMBERED:
            self._forget()
        raw = group.data.tobytes()
        marks = list(self.marks.finditer(raw)) if self.marks is not None and b"<" in raw else []
        if marks:
            # blank the marks out and cut the pieces there
            data = group.data.copy()
            for m in marks:
                data[m.start():m.end()] = 32
            clear = Texts(group.first, data, group.offsets)
        else:
            clear = group
        starts, ends, counts = clear.spans()
        hashes = clear.hashes(starts, ends, clear.prefix_hashes(lower=True))
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            fresh_at = first[new]
            bounds = zip(starts[fresh_at].tolist(), ends[fresh_at].tolist(), strict=True)
            self._learn(unique[new], [raw[a:b].decode() for a, b in bounds])
            at = np.searchsorted(self.known, unique)
        start, size = self.start[at][back], self.size[at][back]
        per_piece = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(start - per_piece[:-1], size) + np.arange(per_piece[-1])]
        before = per_piece[counts]
        if marks:
            places = np.array([m.start() for m in marks])
            ids = np.insert(ids, per_piece[np.searchsorted(starts, places)], [self.special[m.group()] for m in marks])
            before = before + np.searchsorted(places, group.offsets)
        return ids, before


_encoders: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and file; what it remembers outlives a task."""
    text = shared.value
    key = f"{len(text)}:{hash(text)}"
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(text)
    return _encoders[key]


def _shared(df: DataFrame, tokenizer: str):
    """The tokenizer file's text, sent to the workers once; its size is the vocabulary's."""
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def joined(encoder: Encoder, ids: pa.ListArray) -> pa.Array:
    """The strings of the tokens of every list, with a space between; null is as empty."""
    ids = pc.coalesce(ids, pa.scalar([], ids.type))
    strings = encoder.strings.take(ids.flatten())
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), strings), " ")


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids`` array<int>, the tokens of the whole ``text``; null and empty texts have none.

    Equals the tokenizers library's ``encode`` without added special tokens, and
    ``decoded``, if named, its ``decode`` of those ids with special tokens kept.
    Columns of these names are replaced; every other column is kept, ``text`` as
    well. Rows are encoded where they lie, without a shuffle, and each alone,
    so repeated rows and ties do not matter; an empty table stays empty.
    """
    shared = _shared(docs, tokenizer)
    kept = small_batches(docs).drop(ids, *([decoded] if decoded else []))
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())
    column = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for group in texts(batch.column(column)):
                flat, before = encoder.encode(group)
                lists = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(flat.astype(np.int32)))
                part = batch.slice(group.first, len(group))
                more = [joined(encoder, lists)] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns, lists, *more], names=schema.names)

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``, the string of the tokens in ``ids``, special ones included; null is as empty."""
    shared = _shared(encoded, tokenizer)
    kept = encoded.drop(decoded)
    schema = T.StructType([*kept.schema.fields, T.StructField(decoded, T.StringType())])
    column = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            made = joined(encoder, batch.column(column))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=schema.names)

    return kept.mapInArrow(run, schema)


def token_digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of tokens and digests of ids and of the decoded text."""
    ids, decoded = fresh([key, text], "ids", "decoded")
    both = encode(docs.select(key, text), tokenizer, text, ids, decoded)
    return both.select(
        key,
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
    )
