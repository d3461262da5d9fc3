"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are runs of four character classes, with a few measures of repetition and
make-up beside them, so the space speaks of how a text is written, not of its
words or language. The space and the labelled neighbours come from a bounded
sample of labelled rows (:data:`MAX_LABELLED`); what is broadcast is that sample
in :data:`LATENT` dimensions. Every document is compared with every neighbour in
blocks of exact cosine products.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorus.llm.common import small_batches
from chorus.llm.vector_text import Texts, distinct, shingles, texts
from chorus.operators.scale import lookup, pin

MAX_LABELLED = 4096
TERMS = 1024
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK = 512
MEASURES = 12
MEASURE_WEIGHT = 0.35

# Classes of bytes: letters (and all beyond ASCII), capitals, digits, blanks, breaks, then marks by kind.
_CLASSES = np.zeros(256, np.uint32)
_SIGNS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".", ",", "!?", ";:'\"-()[]", "#*$%&|<>",
    "@/\\_=+~^`{}",
)
for _k, _signs in enumerate(_SIGNS, 1):
    _CLASSES[[ord(c) for c in _signs]] = _k
_CLASSES[:9] = _CLASSES[14:32] = 11


def term_counts(group: Texts) -> np.ndarray:
    """Counts of hashed class runs, one row per text."""
    n = len(group)
    out = np.zeros(n * TERMS)
    if len(group.data) >= 4:
        c = _CLASSES[group.data]
        run = ((c[:-3] * 12 + c[1:-2]) * 12 + c[2:-1]) * 12 + c[3:]
        term = (run * np.uint32(2654435761)) >> np.uint32(22)
        owner = np.repeat(np.arange(n), np.diff(group.offsets))
        same = owner[:-3] == owner[3:]
        out = np.bincount(owner[:-3][same] * TERMS + term[same], minlength=n * TERMS).astype(float)
    return out.reshape(n, TERMS)


def measures(group: Texts) -> np.ndarray:
    """Make-up and repetition of every text, each between 0 and 1."""
    n, data, offsets = len(group), group.data, group.offsets
    size = np.maximum(np.diff(offsets), 1)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    share = np.bincount(owner * 12 + _CLASSES[data], minlength=n * 12).reshape(n, 12) / size[:, None]
    words, counts = group.words()
    n_words = np.diff(counts)
    out = np.zeros((n, MEASURES))
    out[:, :7] = np.sqrt(share[:, [1, 2, 4, 7, 8, 9, 10]])
    out[:, 7] = np.minimum(size / np.maximum(n_words, 1) / 20, 1)
    runs, of = shingles(words, counts, 3)
    out[:, 8] = 1 - np.bincount(distinct(runs, of)[1], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)
    out[n_words == 0, 8] = 0
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    hashes = group.hashes(starts, ends, group.prefix_hashes())
    line_of = owner[starts]
    written = ends - starts > 1
    lines = np.bincount(line_of[written], minlength=n)
    once = np.bincount(distinct(hashes[written], line_of[written])[1], minlength=n)
    out[:, 9] = 1 - once / np.maximum(lines, 1)
    out[lines == 0, 9] = 0
    out[:, 10] = n_words == 0
    out[:, 11] = 1.0
    return out


@dataclass(frozen=True)
class Space:
    """Weights of the terms, the latent basis, and the labelled vectors with their labels."""

    idf: np.ndarray
    scale: float
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, group: Texts) -> np.ndarray:
        return _unit(_rows(term_counts(group), measures(group), self.idf, self.scale) @ self.basis)

    def vote(self, places: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the prior weighs as one far neighbour."""
        if not len(self.labels):
            return np.full(len(places), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.empty(len(places))
        for start in range(0, len(places), BLOCK):
            cosine = places[start:start + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float) ** SHARPNESS
            out[start:start + BLOCK] = ((weight * self.labels[near]).sum(1) + 1e-3 * self.prior) / (weight.sum(1) + 1e-3)
        return out


def _rows(counts: np.ndarray, extra: np.ndarray, idf: np.ndarray, scale: float) -> np.ndarray:
    x = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)) * idf
    return np.hstack([x, extra * scale]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return np.where(length > 1e-9, x / np.maximum(length, 1e-9), 0).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group in texts(batch.column(0)):
            rows = np.hstack([term_counts(group), measures(group)]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([
                pa.array([r.tobytes() for r in rows], pa.binary()),
                *[batch.column(i).slice(group.first, len(group)) for i in (1, 2)],
            ], names=["features", "label", "place"])


def fit(labelled: DataFrame, label: str, text: str = "text", most: int = MAX_LABELLED) -> Space:
    """The space of at most ``most`` labelled rows, chosen by a hash of the text alone; no more reach the driver.

    Rows without a label (null or neither 0 nor 1) are left out. Equal texts
    count once, with their mean label. Without any row every score is 0.5.
    """
    named = labelled.filter(F.col(label).isin(0, 1)).select(
        F.coalesce(F.col(text), F.lit("")).alias("body"), F.col(label).cast("double").alias("label")
    )
    hashed = named.withColumn("place", F.xxhash64("body"))
    known = hashed.groupBy("place").agg(F.avg("label").alias("label"))
    known = pin(known, "labels")
    count = known.count()
    if not count:
        return Space(np.ones(TERMS), 1.0, np.zeros((TERMS + MEASURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    mean = known.agg(F.avg("label")).first()[0]
    bound = int(min(1.0, most / count) * 2**62)
    picked = known.filter(F.shiftrightunsigned("place", 2) <= F.lit(bound)).orderBy("place").limit(most)
    bodies = hashed.select("body", "place").join(F.broadcast(picked), "place").dropDuplicates(["place"])
    got = bodies.select("body", "label", "place").mapInArrow(_features, "features binary, label double, place bigint").toArrow()
    first = np.argsort(got["place"].to_numpy())
    labels = got["label"].to_numpy()[first]
    raw = np.frombuffer(b"".join(got["features"].take(pa.array(first)).to_pylist()), np.float32)
    raw = raw.reshape(len(first), TERMS + MEASURES).astype(float)
    counts, extra = raw[:, :TERMS], raw[:, TERMS:]
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 0.2
    plain = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)) * idf
    scale = MEASURE_WEIGHT * float(np.sqrt((plain * plain).sum(1).mean())) + 1e-3
    rows = _rows(counts, extra, idf, scale).astype(float)
    values, vectors = np.linalg.eigh(rows.T @ rows)
    basis = vectors[:, ::-1][:, :LATENT].astype(np.float32)
    return Space(idf, scale, basis, _unit(rows.astype(np.float32) @ basis), labels, float(mean))


def with_score(docs: DataFrame, space: Space, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score``: the share of label 1 among the neighbours of the whole text, from 0 to 1.

    Null and empty texts are scored as any other text without a character. Every
    row is scored for itself where it lies; a column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    kept = small_batches(docs).drop(score)
    schema = T.StructType([*kept.schema.fields, T.StructField(score, T.DoubleType())])
    column = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in texts(batch.column(column)):
                scores = shared.value.vote(shared.value.place(group))
                part = batch.slice(group.first, len(group))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.clip(scores, 0.0, 1.0))], names=schema.names
                )

    return kept.mapInArrow(run, schema)


def with_labels(docs: DataFrame, labels: DataFrame, label: str, text: str = "text") -> DataFrame:
    """``text`` and label of the documents that have one; text moves only past the broadcast limit.

    Labels repeated for an id are averaged and rounded; a null id has none.
    """
    one = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.round(F.avg(label)).cast("int").alias(label)
    )
    return lookup(docs.select("doc_id", text), pin(one, "label"), ["doc_id"])
