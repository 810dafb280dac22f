"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

1. Every text becomes counts of hashed byte trigrams and of a few shape terms (repeated words,
   capitals, symbols). Document frequencies are counted over all documents.
2. A bounded, seeded sample of labelled rows (``max_labelled``) is turned into TF-IDF rows and a
   truncated SVD; its latent vectors and labels are the reference set. They and the projection
   are the only broadcast: max_labelled x rank + FEATURES x rank floats.
3. Every document is projected and compared with all reference vectors in blocks (exact cosine
   products); the nearest ``k`` vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shelfcast.llm.common import packed, unpacked
from shelfcast.llm.textops import Slice, slices

TRIGRAM_BITS = 12
FEATURES = (1 << TRIGRAM_BITS) + 16
THRESHOLD = 0.3
#: Held-out rule and bound of the labelled sample.
FOLDS, MAX_LABELLED, RANK, NEIGHBOURS = 5, 4096, 64, 15
#: The shape terms share a document's vector with thousands of trigrams; this weighs them up.
SHAPE_WEIGHT = 6.0
_CLASS = np.full(256, -1, np.int64)
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[10] = 3
for _i, _c in enumerate(b"!#*$%&|<>"):
    _CLASS[_c] = 4 + _i


def counts(s: Slice) -> np.ndarray:
    """Hashed term counts of each text, one row a text."""
    base, n = 1 << TRIGRAM_BITS, len(s.data)
    size = np.diff(s.off)
    out = np.zeros((s.n, FEATURES), np.float32)
    if n >= 3:
        d = s.data.astype(np.uint32)
        code = ((d[:-2] << 16) | (d[1:-1] << 8) | d[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - TRIGRAM_BITS)
        doc = np.repeat(np.arange(s.n), size)
        whole = doc[:-2] == doc[2:]
        out[:, :base] = np.bincount(doc[:-2][whole] * base + code[whole], minlength=s.n * base).reshape(s.n, base)
    kind = _CLASS[s.data]
    at = np.flatnonzero(kind >= 0)
    if len(at):
        doc = np.searchsorted(s.off, at, "right") - 1
        out[:, base:] += np.bincount(doc * 16 + kind[at], minlength=s.n * 16).reshape(s.n, 16)
    h, doc = s.word_hash(), s.doc_of_word()
    same = doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]
    out[:, base] += np.bincount(same, minlength=s.n)
    # shape terms count by their share of the text, in steps a logarithm can tell apart
    out[:, base:] *= (1000.0 / np.maximum(size, 1))[:, None]
    return out


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows; an empty text stays zero."""
    x = np.log1p(c) * idf
    x[:, 1 << TRIGRAM_BITS:] *= SHAPE_WEIGHT
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hashed term occurs, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for b in batches:
            for s in slices(b.column("text")):
                df += (counts(s) > 0).sum(0)
                n += s.n
        yield pa.RecordBatch.from_pydict({"term": np.arange(-1, FEATURES, dtype=np.int32), "n": np.concatenate([[n], df])})

    got = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by = {r["term"]: r["n"] for r in got}
    return np.array([by.get(i, 0) for i in range(FEATURES)], np.float64), int(by.get(-1, 0))


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, fold: int = 0):
    """Whether crc32(doc_id as text) mod ``folds`` is ``fold``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of a seeded sample of the labelled rows outside the held-out fold."""
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.avg("quality").cast("double").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column("text")):
                c = counts(s)
                at = [np.flatnonzero(r) for r in c]
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                    "c": pa.array([r[a].tobytes() for r, a in zip(c, at)], pa.binary()),
                    "y": b.column("y").slice(s.first, s.n)})

    # rows in a fixed order, so that reruns learn the same; ids that repeat in documents stay within the bound
    got = rows.mapInArrow(run, "at binary, c binary, y double").orderBy(F.xxhash64("at", "c"), "y").limit(limit).collect()
    x, y = np.zeros((len(got), FEATURES), np.float32), np.zeros(len(got), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["c"], np.float32)
        y[i] = r["y"]
    return x, y


def latent_space(x: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the labelled rows, by a seeded randomised SVD."""
    rank = min(rank, *x.shape) if len(x) else 0
    if not rank:
        return np.zeros((FEATURES, 1), np.float32)
    q = np.random.Generator(np.random.PCG64(5)).standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T[:, :rank]).astype(np.float32)


def unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-9)


def vote(z: np.ndarray, ref: np.ndarray, y: np.ndarray, prior: float, k: int) -> np.ndarray:
    """Similarity-weighted label of the ``k`` nearest reference vectors; the prior if none is near."""
    if not len(ref):
        return np.full(len(z), prior)
    sim = z @ ref.T
    k = min(k, len(ref))
    near = np.argpartition(sim, len(ref) - k, axis=1)[:, len(ref) - k:]
    w = np.maximum(np.take_along_axis(sim, near, 1), 0).astype(np.float64) ** 8
    return np.clip(((w * y[near]).sum(1) + 1e-3 * prior) / (w.sum(1) + 1e-3), 0, 1)


def knn_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rank: int = RANK,
                k: int = NEIGHBOURS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``_row`` (a struct of the ``keep`` columns) and ``_score`` (0 to 1) of every row of ``docs``.

    Only texts are read for a score. Null and empty texts get the labelled share of label 1, as
    does every text when nothing is labelled (then 0.5).
    """
    df, n = document_frequencies(docs)
    idf = np.log((n + 1.0) / (df + 1.0)).astype(np.float32) + 1.0
    x, y = labelled_sample(docs, labels, max_labelled)
    prior = float(y.mean()) if len(y) else 0.5
    x = weighted(x, idf)
    space = latent_space(x, rank)
    ref = unit(x @ space) if len(y) else np.zeros((0, 1), np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((idf, space, ref, y, prior, k))
    source = packed(docs, F.col("text"), keep=keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, space, ref, y, prior, k = sent.value
        for b in batches:
            for s in slices(b.column("text")):
                score = np.empty(s.n)
                c = counts(s)
                for i in range(0, s.n, 256):
                    score[i:i + 256] = vote(unit(weighted(c[i:i + 256], idf) @ space), ref, y, prior, k)
                score[np.diff(s.off) == 0] = prior
                yield pa.RecordBatch.from_arrays([b.column("_row").slice(s.first, s.n), pa.array(score)], names=["_row", "_score"])

    return source.mapInArrow(run, StructType([source.schema["_row"], StructField("_score", DoubleType())]))


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = unpacked(knn_quality(docs, labels), F.col("_score").alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns."""
    return unpacked(knn_quality(docs, labels, keep=tuple(docs.columns)).where(F.col("_score") >= threshold))
