"""Substring dedup with repeated-phrase automata.

A window is WINDOW successive words of one text. A word goes if a window that covers it also
starts anywhere else, in the same text or another. Equal texts are handled once, with their number.

1. Anchors. Every window names the 8-word gram in it with the least hash (the leftmost of
   equals); equal windows name equal grams at equal places. Only anchors are counted over the
   corpus, about one word in fourteen. An anchor found once lies in no recurring window. The
   stretch of an anchor is the words of all windows that name it; equal stretches are one kind.
2. Confirmation. The windows of each kind around a recurring anchor are hashed from its text and
   counted. A window counted twice is a recurring passage; the first kind that has it stands for
   it. Successive windows that the same kinds have are one phrase.
3. Automata. Phrases are sharded by their anchor; an Aho-Corasick automaton is compiled for each
   shard. The stretches of the corpus are streamed through the automaton of their anchor, and
   every occurrence of every phrase is located. An anchor with many kinds is dealt to several
   tasks, each with its own copy of that anchor's phrases.
4. The words that occurrences cover are removed.

Texts below WINDOW words hold no window and stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfcast.llm.common import packed, stage, unpacked
from shelfcast.llm.textops import Ranges, Slice, grams, slices

WINDOW, GRAM = 35, 8
#: Kinds of one anchor that one task takes; an anchor with more is dealt to several.
DEAL = 2000
#: Recurring anchors of a shard, so about this many phrases an automaton.
ANCHORS_A_SHARD = 1000
#: Texts that stand for kinds, up to which their keys are broadcast (with their stretches, some
#: 400 bytes each) to the scan that fetches them; beyond, the join shuffles.
BROADCAST_TEXTS = 100_000
KEY = ["k1", "k2"]
_U = np.uint64


def anchors(s: Slice, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor occurrences of a slice: gram hash, text, first window that names it (counted from
    the text's first word) and how many windows in a row do."""
    none = np.zeros(0, np.int64)
    if len(codes) < WINDOW:
        return none.astype(_U), none, none, none
    span = WINDOW - GRAM + 1  # grams in a window
    at = np.arange(len(codes) - GRAM + 1)
    h = Ranges(codes)(at, at + GRAM)
    # leftmost least gram of 2, 4, 8, 16 and then `span` successive grams, by doubling
    best, width = at, 1
    while True:
        shift = min(width, span - width)
        one, two = best[:-shift], best[shift:]
        best = np.where(h[two] < h[one], two, one)
        width += shift
        if width == span:
            break
    start = np.arange(len(best))
    doc = np.searchsorted(s.woff, start, "right") - 1
    whole = start + WINDOW <= s.woff[1:][doc]
    best, start, doc = best[whole], start[whole], doc[whole]
    if not len(best):
        return none.astype(_U), none, none, none
    new = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])]))
    return h[best[new]], doc[new], start[new] - s.woff[doc[new]], np.diff(np.append(new, len(best)))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each text that has any: gram hash, hash of the stretch, first window, windows."""
    for b in batches:
        for s in slices(b.column("text")):
            codes = s.word_hash()
            h, doc, first, n = anchors(s, codes)
            begin = s.woff[doc] + first
            kind = Ranges(codes, second=True)(begin, begin + n + WINDOW - 1)
            spots = pa.StructArray.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(kind.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["h", "kind", "first", "n"])
            off = np.searchsorted(doc, np.arange(s.n + 1)).astype(np.int32)
            full = pa.array(np.diff(off) > 0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).slice(s.first, s.n).filter(full) for k in KEY), pa.ListArray.from_arrays(pa.array(off), spots).filter(full)],
                names=[*KEY, "spots"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each kind, from the text that stands for it."""
    for b in batches:
        for s in slices(b.column("text")):
            spots = b.column("spots").slice(s.first, s.n)
            doc = np.repeat(np.arange(s.n), np.diff(spots.offsets.to_numpy()))
            flat = spots.flatten()
            begin = s.woff[doc] + flat.field("first").to_numpy()
            last = begin + flat.field("n").to_numpy() + WINDOW - 2
            raw = s.data.tobytes()
            text = [b" ".join(raw[i:j].split()) for i, j in zip(s.start[begin].tolist(), s.end[last].tolist())]
            at = pa.array(s.first + doc)
            yield pa.RecordBatch.from_arrays([b.column("tid").take(at), *(flat.field(k) for k in ("h", "kid", "c", "deals", "first")),
                                              pa.array(text, pa.binary()).cast(pa.string())], names=["tid", "h", "kid", "c", "deals", "first", "text"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each window of each kind, with its place in the text that stands for the kind."""
    for b in batches:
        for s in slices(b.column("text")):
            at, w = grams(s, s.word_hash(), WINDOW)
            doc = np.searchsorted(s.woff, at, "right") - 1
            take = pa.array(s.first + doc)
            first = b.column("first").take(take).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("h").take(take), pa.array(w.view(np.int64)), b.column("kid").take(take), b.column("c").take(take),
                 b.column("tid").take(take), pa.array((first + at - s.woff[doc]).astype(np.int32))],
                names=["h", "w", "kid", "c", "tid", "start"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut phrases out of texts: successive confirmed windows of one anchor that the same kinds
    have, so that a phrase occurs wherever one of its windows does."""
    for b in batches:
        out = []
        for text, at in zip(b.column("text").to_pylist(), b.column("at").to_pylist()):
            words = text.encode().split()
            begin = at[0]["at"]
            for this, after in zip(at, [*at[1:], None]):
                if after is None or after["h"] != this["h"] or after["at"] != this["at"] + 1 or after["in"] != this["in"]:
                    out.append((this["h"], b" ".join(words[begin:this["at"] + WINDOW]).decode()))
                    begin = after["at"] if after else 0
        yield pa.RecordBatch.from_pydict({"h": pa.array([o[0] for o in out], pa.int64()), "text": pa.array([o[1] for o in out], pa.string())})


class Automaton:
    """Phrases over words: a word is one character, so positions are word positions."""

    def __init__(self):
        self.ids: dict[str, str] = {}
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.phrases = 0

    def add(self, phrase: str) -> None:
        ids = self.ids
        # surrogates are no characters of a string key
        key = "".join([ids.setdefault(w, chr(len(ids) + (1 if len(ids) < 0xD7FF else 0x801))) for w in phrase.split(" ")])
        self.auto.add_word(key, len(key))
        self.phrases += 1

    def compile(self) -> None:
        if self.phrases:
            self.auto.make_automaton()

    def covered(self, text: str) -> list[tuple[int, int]]:
        """Word ranges that occurrences of phrases cover, joined."""
        if not self.phrases:
            return []
        get = self.ids.get
        out: list[tuple[int, int]] = []
        for end, size in self.auto.iter("".join([get(w, "\0") for w in text.split(" ")])):
            lo, hi = end + 1 - size, end + 1
            while out and lo <= out[-1][1]:
                a, z = out.pop()
                lo, hi = min(lo, a), max(hi, z)
            out.append((lo, hi))
        return out


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (shard, deal), phrases before stretches: compile, then stream."""
    here, auto, ready = None, Automaton(), False
    for b in batches:
        kid, lo, hi = [], [], []
        for shard, deal, row, text in zip(*(b.column(c).to_pylist() for c in ("shard", "deal", "kid", "text"))):
            if (shard, deal) != here:
                here, auto, ready = (shard, deal), Automaton(), False
            if row is None:
                auto.add(text)
                continue
            if not ready:
                auto.compile()
                ready = True
            for a, z in auto.covered(text):
                kid.append(row)
                lo.append(a)
                hi.append(z)
        if kid:
            yield pa.RecordBatch.from_pydict({"kid": pa.array(kid, pa.int64()), "lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32())})


def _join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the sorted ranges of each text that meet or overlap: a copied passage is one range."""
    for b in batches:
        out = []
        for ranges in b.column("ranges").to_pylist():
            joined: list[dict] = []
            for r in ranges:
                if joined and r["lo"] <= joined[-1]["hi"]:
                    joined[-1]["hi"] = max(joined[-1]["hi"], r["hi"])
                else:
                    joined.append(r)
            out.append(joined)
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in KEY), pa.array(out, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                                         names=[*KEY, "ranges"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """k1, k2 and the sorted word ranges (``lo``, ``hi``) that recurring windows cover, for the
    different texts of ``docs`` (k1, k2, text) that have any."""
    # anchors are found twice, from the input, rather than kept: they would take half its size
    found = docs.mapInArrow(_find, "k1 long, k2 long, spots array<struct<h:long,kind:long,first:int,n:int>>")
    spots = found.select(*KEY, F.explode("spots").alias("s")).select(*KEY, "s.*")
    again = stage(spots.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                  .select("h", F.ceil(F.col("c") / DEAL).cast("int").alias("deals")), "recurring-anchors", release=True)
    shards = max(1, -(-again.count() // ANCHORS_A_SHARD))
    # where a kind occurs, equal texts once with their number
    places = stage(spots.join(again, "h").groupBy(*KEY, "h", "deals", F.xxhash64("h", "kind").alias("kid"), "first", "n")
                   .agg(F.count(F.lit(1)).alias("m")), "places", release=True, codec="zstd")
    kinds = places.groupBy("kid").agg(F.sum("m").alias("c"), F.first("h").alias("h"), F.first("deals").alias("deals"),
                                      F.min(F.struct(*KEY, "first", "n")).alias("one"))
    stands = stage(kinds.groupBy(F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2")).agg(
        F.sort_array(F.collect_list(F.struct("one.first", "one.n", "h", "kid", "c", "deals"))).alias("spots")), "stands")
    few = stands.count() <= BROADCAST_TEXTS
    fetched = (docs.join(F.broadcast(stands.select(*KEY)) if few else stands.select(*KEY), KEY, "left_semi")
               .groupBy(*KEY).agg(F.first("text").alias("text")).join(stands, KEY))
    fetched = stage(fetched.select(F.monotonically_increasing_id().alias("tid"), "text", "spots"), "fetched", release=True, codec="zstd")
    stretches = fetched.mapInArrow(_stretches, "tid long, h long, kid long, c long, deals int, first int, text string")

    # confirm
    twice = (stretches.mapInArrow(_windows, "h long, w long, kid long, c long, tid long, start int")
             .groupBy("h", "w").agg(F.sum("c").alias("c"), F.min(F.struct("tid", "start")).alias("k"), F.bit_xor("kid").alias("in")).where("c > 1"))
    # a job of its own: the shuffle files of all windows are gone before the texts of the recurring ones are gathered
    twice = stage(twice.select("h", "k", "in"), "twice", release=True, codec="zstd")
    # a window stands where its first text has it; successive ones of one anchor make a phrase
    picked = twice.groupBy(F.col("k.tid").alias("tid")).agg(
        F.sort_array(F.collect_list(F.struct("h", F.col("k.start").alias("at"), "in"))).alias("at"))
    phrases = (fetched.select("tid", "text").join(picked, "tid").select("text", "at").mapInArrow(_runs, "h long, text string")
               .join(again, "h"))
    # and so are those of the texts before the phrases are located
    phrases = stage(phrases, "phrases", release=True, codec="zstd")

    # locate; a dealt anchor has a shard of its own, below zero
    shard = F.when(F.col("deals") > 1, -1 - F.pmod("h", F.lit(1 << 30))).otherwise(F.pmod("h", F.lit(shards))).cast("int").alias("shard")
    left = phrases.select(shard, F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.lit(None).cast("long").alias("kid"), "text")
    right = stretches.select(shard, F.pmod(F.xxhash64("kid"), F.col("deals")).cast("int").alias("deal"), "kid", "text")
    located = (left.unionAll(right).repartition("shard", "deal").sortWithinPartitions("shard", "deal", F.col("kid").asc_nulls_first())
               .mapInArrow(_locate, "kid long, lo int, hi int").groupBy("kid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    spans = places.select(*KEY, "kid", "first").join(located, "kid").select(
        *KEY, F.explode(F.transform("spans", lambda r: F.struct((F.col("first") + r["lo"]).alias("lo"), (F.col("first") + r["hi"]).alias("hi")))).alias("r"))
    ranges = "array<struct<lo:int,hi:int>>"
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_list("r")).alias("ranges")).mapInArrow(_join_ranges, f"k1 long, k2 long, ranges {ranges}")


def _remove(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ranges = b.column("text").to_pylist(), b.column("ranges").to_pylist()
            words, removed, out = [], [], []
            for text, rs in zip(texts, ranges):
                w = (text or "").encode().split()
                kept, at, gone = [], 0, 0
                for r in rs or ():
                    lo, hi = max(r["lo"], at), r["hi"]
                    if hi > lo:
                        kept += w[at:lo]
                        gone += hi - lo
                        at = hi
                kept += w[at:]
                words.append(len(w))
                removed.append(gone)
                joined = b" ".join(kept)
                out.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                                             names=["_row", "_words", "_removed", "_out"])

    return run


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """``keep`` columns, n_words, n_removed and the kept words joined by one space (``kept_text``),
    or that text's SHA-256 (``kept_sha256``), for every row of ``docs``.

    Null and empty texts have no words. Repeated rows are texts of their own, so each is a
    repetition of the other. Columns of ``docs`` named like a result are replaced by it.
    """
    # a text is known by 128 bits of its content, so no numbering of rows has to outlive a lost executor
    key = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), F.col("text")).alias("k2")]
    ranges = stage(repeated_ranges(docs.where(F.col("text").isNotNull()).select(*key, "text")), "ranges", release=True)
    rows = packed(docs, F.col("text"), *key, keep=keep)
    joined = rows.join(ranges, KEY, "left").select("_row", "text", "ranges")
    schema = StructType([rows.schema["_row"], StructField("_words", LongType()), StructField("_removed", LongType()), StructField("_out", StringType())])
    names = ("n_words", "n_removed", "kept_sha256" if digest else "kept_text")
    return unpacked(joined.mapInArrow(_remove(digest), schema),
                    *[F.col(c).alias(n) for c, n in zip(("_words", "_removed", "_out"), names)], replace=names)


def op2(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, digest=True)
