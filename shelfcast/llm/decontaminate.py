"""Benchmark decontamination: BM25 index of test items, block-max WAND, overlap check.

The benchmark items are the indexed documents; every passage of every training text (64 words,
a new one every 32) is a query. An item's threshold is a share of the least score that any
33 successive words of it have, so every whole copy is above it wherever passages are cut. Items
lie in blocks sorted by threshold. A passage's bound for a block is the sum of its distinct
words' block maxima; only blocks whose bound reaches their least threshold are scored exactly
(the skipping rule of block-max WAND, for all passages of a slice at once). Every hit is then
verified on the text around the passage: enough of the question's and of the answer's word
trigrams must be there. An item's answer is its last sentence (if
there is only one, its last third), but three words at least.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.textops import Ranges, Slice, slices

STRIDE = 32
#: BM25 constants; share of the threshold; least overlap of question and answer.
K1, B, SHARE, OVERLAP = 1.2, 0.75, 0.8, 0.6
#: Shorter items say too little to be looked for.
MIN_ITEM_WORDS = 5
ITEMS_A_BLOCK, BLOCKS_A_SHARD = 8, 32
#: Bytes of items indexed and broadcast at a time; a larger benchmark is searched in several rounds.
INDEX_BYTES = 32 << 20


def word_codes(text: str) -> np.ndarray:
    for s in slices(pa.array([text])):
        return s.folded().word_hash()
    return np.zeros(0, np.uint64)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"\w", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, (2 * len(words) + 2) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def trigrams(codes: np.ndarray) -> np.ndarray:
    k = min(3, len(codes))
    if not k:
        return np.zeros(0, np.uint64)
    at = np.arange(len(codes) - k + 1)
    return np.unique(Ranges(codes)(at, at + k))


class Shard:
    """Inverted index of some items: word -> impact in each item, and maxima by block."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], df: dict, n: int, mean: float):
        vocab = np.unique(np.concatenate([codes for _, codes, _, _ in items]))
        weight = np.zeros((len(vocab), len(items)), np.float32)
        for j, (_, codes, _, _) in enumerate(items):
            word, tf = np.unique(codes, return_counts=True)
            idf = np.log(1 + (n - np.array([df[w] for w in word.tolist()]) + 0.5) / (np.array([df[w] for w in word.tolist()]) + 0.5))
            weight[np.searchsorted(vocab, word), j] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(codes) / mean))
        need = np.zeros(len(items), np.float32)
        for j, (_, codes, _, _) in enumerate(items):
            at = np.searchsorted(vocab, codes)
            span = min(len(codes), STRIDE + 1)
            need[j] = SHARE * min(weight[np.unique(at[i:i + span]), j].sum() for i in range(len(codes) - span + 1))
        order = np.argsort(need, kind="stable")
        self.vocab, self.items = vocab, [items[j] for j in order]
        self.weight, self.need = weight[:, order], need[order]
        edges = np.arange(0, len(items), ITEMS_A_BLOCK)
        self.edges = np.append(edges, len(items))
        self.block_max = np.maximum.reduceat(self.weight, edges, axis=1)
        self.block_need = np.minimum.reduceat(self.need, edges)

    def search(self, codes: np.ndarray, woff: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the passage, item, score) of all passages and items above threshold."""
        size = np.diff(woff)
        strides = np.maximum(-(-size // STRIDE), 0)
        first = np.concatenate([[0], np.cumsum(strides)])
        if not first[-1]:
            return
        text = np.repeat(np.arange(len(size)), strides)
        spot = np.minimum(np.searchsorted(self.vocab, codes), len(self.vocab) - 1)
        at = np.flatnonzero(self.vocab[spot] == codes)
        if not len(at):
            return
        doc = np.searchsorted(woff, at, "right") - 1
        stride = first[doc] + (at - woff[doc]) // STRIDE
        pair = np.unique(stride.astype(np.int64) * len(self.vocab) + spot[at])  # each word once a stride
        stride, word = pair // len(self.vocab), pair % len(self.vocab)
        full, begin = np.unique(stride, return_index=True)
        half = np.zeros((first[-1] + 1, len(self.block_need)), np.float32)
        half[full] = np.add.reduceat(self.block_max[word], begin, axis=0)
        bound = half[:-1]
        bound[:-1] += half[1:-1] * (text[1:] == text[:-1])[:, None]  # a passage is a stride and the next of its text
        span = np.searchsorted(stride, np.arange(first[-1] + 2))
        hit, block = np.nonzero(bound >= self.block_need)
        for p, b in zip(hit.tolist(), block.tolist()):
            end = p + 2 if p + 1 < first[-1] and text[p + 1] == text[p] else p + 1
            words = np.unique(word[span[p]:span[end]])
            lo, hi = self.edges[b], self.edges[b + 1]
            score = self.weight[words, lo:hi].sum(0)
            for j in np.flatnonzero(score >= self.need[lo:hi]):
                yield int(text[p]), int(woff[text[p]] + (p - first[text[p]]) * STRIDE), int(lo + j), float(score[j])


def build(items: list[tuple[int, str]]) -> list[Shard]:
    """Index (item number, text) pairs in shards of a few hundred items."""
    ready = []
    for number, text in items:
        codes = word_codes(text)
        if len(codes) >= MIN_ITEM_WORDS:
            n = len(word_codes(split_item(text)[1]))
            ready.append((number, codes, trigrams(codes[:max(len(codes) - n, 3)]), trigrams(codes[-max(n, 3):])))
    df: dict = {}
    for _, codes, _, _ in ready:
        for w in np.unique(codes).tolist():
            df[w] = df.get(w, 0) + 1
    mean = float(np.mean([len(c) for _, c, _, _ in ready])) if ready else 1.0
    step = ITEMS_A_BLOCK * BLOCKS_A_SHARD
    ready.sort(key=lambda r: len(r[1]))
    return [Shard(ready[i:i + step], df, len(ready), mean) for i in range(0, len(ready), step)]


def leaks(s: Slice, shards: list[Shard]) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(text, item number) -> best score, question and answer overlap of the verified pairs."""
    codes = s.folded().word_hash()
    found: dict = {}
    for shard in shards:
        for text, start, j, score in shard.search(codes, s.woff):
            number, item, question, answer = shard.items[j]
            lo = max(int(s.woff[text]), start - len(item))
            around = trigrams(codes[lo:min(int(s.woff[text + 1]), start + 2 * STRIDE + len(item))])
            share = [float(np.isin(part, around).mean()) if len(part) else 1.0 for part in (question, answer)]
            if min(share) >= OVERLAP and score > found.get((text, number), (-1.0,))[0]:
                found[text, number] = (score, *share)
    return found


def indexes(benchmark: DataFrame, index_bytes: int) -> Iterator[tuple[list[Shard], list]]:
    """The index, in as many rounds as its text takes at ``index_bytes`` each, and the item ids."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-int(total) // index_bytes))
    for r in range(rounds):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == r) if rounds > 1 else items
        got = sorted(((x["item_id"], x["text"]) for x in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield build([(i, t) for i, (_, t) in enumerate(got)]), [i for i, _ in got]


def find_leaks(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row for each (row of ``docs``, benchmark item) that overlaps: doc_id, item_id, score,
    question_overlap, answer_overlap.

    Null and empty texts and items match nothing; repeated items each give a row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    out = None
    for index in indexes(benchmark, index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shards, ids = sent.value
            for b in batches:
                for s in slices(b.column("text")):
                    hits = sorted(leaks(s, shards).items())
                    if hits:
                        at = pa.array([s.first + t for (t, _), _ in hits], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [b.column("doc_id").take(at), pa.array([ids[i] for (_, i), _ in hits], pa.int64()),
                             *(pa.array([v[k] for _, v in hits], pa.float64()) for k in range(3))],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = docs.select("doc_id", "text").mapInArrow(
            run, f"doc_id {kind}, item_id long, score double, question_overlap double, answer_overlap double")
        out = found if out is None else out.unionAll(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, unchanged; one narrow pass a round."""
    for index in indexes(benchmark, index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shards, _ = sent.value
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for s in slices(b.column("text")):
                    clean[[s.first + t for t, _ in leaks(s, shards)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
