"""Substring dedup with run-length indexes.

A window is WIDTH successive bytes of one text. A byte goes if a window that covers it also starts
earlier: in a document of smaller id, or before it in the same one. A text that several documents hold is
handled once; the others go whole if they hold a window.

1. **Anchors.** Every window names the gram of GRAM bytes in it with the least hash (the leftmost of
   equals); equal windows name equal grams at equal offsets. The windows in a row that name one
   occurrence of a gram, with the bytes they cover, are a stretch, so every window is in one stretch
   and equal windows are in stretches of one anchor. Only anchors that occur more than once go on:
   they are counted first, and a bitmap of fixed size keeps most others out of the shuffle.
2. **Kinds.** Equal stretches of one anchor are one kind. All its occurrences but the earliest go.
3. **Index.** The kinds of anchors with more than one kind are dealt to shards by anchor. For each shard a
   run-length index (``run_index``) is built over its stretches, in order of their places; they are streamed
   through it, and windows that an earlier stretch has too are marked.
4. An anchor with more than DEAL kinds (a phrase in very many surroundings) is cut finer before: into
   blocks of successive windows, dealt by the bytes that all windows of a block cover. Equal windows stay
   together, different surroundings part. The finest blocks are single windows, of which equal ones are one kind.

Long texts are handled in pieces that overlap by a window, so no task holds more than a piece beside the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shelfcast.llm.common import packed, stage, unpacked
from shelfcast.llm.run_index import RunIndex
from shelfcast.llm.textops import Ranges, mix64

WIDTH, GRAM = 100, 32
#: Windows of a block, coarsest first, where an anchor has more than DEAL kinds.
FINER, DEAL = (8, 1), 5000
#: Bytes of stretches in one index, on average.
SHARD_BYTES = 1 << 20
#: Bytes of text handled at a time, and of the pieces of a longer text.
SLICE, PIECE = 1 << 19, 1 << 21
#: Bits of the bitmaps of recurring anchors and of places: 8 MB whatever the input's size. What
#: a full bitmap lets through is dropped by the shuffles that follow.
CELLS = 1 << 26
#: Texts with copies, up to which their table (some 50 bytes each) is broadcast to the scans.
BROADCAST_TEXTS = 200_000
NULL_ID = -(1 << 63)
PLACE = ["d", "k1", "start"]
_U = np.uint64
_GRAM_CODES = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xA0761D6478BD642F)]
_BYTES = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_POSITION = _U((1 << 24) - 1)


def byte_slices(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, offset in its text, bytes, piece offsets) of about SLICE bytes of texts, or of one
    piece of a long text. Texts shorter than a window are left out."""
    blob = pc.fill_null(texts, b"").cast(pa.large_binary())
    off = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset : blob.offset + len(blob) + 1] if len(blob) else np.zeros(1, np.int64)
    data = np.frombuffer(blob.buffers()[2], np.uint8) if blob.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(blob):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, "right")) - 1)
        if off[i + 1] - off[i] > PIECE:
            for a in range(0, int(off[i + 1] - off[i]) - width + 1, PIECE):
                z = min(int(off[i] + a + PIECE + width - 1), int(off[i + 1]))
                yield np.array([i]), np.array([a]), data[off[i] + a : z], np.array([0, z - off[i] - a])
            i += 1
            continue
        if off[j] - off[i] >= width:
            yield np.arange(i, j), np.zeros(j - i, np.int64), data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def anchors(data: np.ndarray, off: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor occurrences: gram hash, text, first window that names it (from the text's start), windows
    in a row that do, and the gram's offset from the first of them. ``gram``: 8, 16, 24 or 32."""
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none.astype(_U), none, none, none, none
    grams = len(data) - gram + 1
    words = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))  # eight bytes from every position on
    h = np.zeros(grams, _U)
    for j in range(gram // 8):
        x = words[8 * j : 8 * j + grams] * _GRAM_CODES[j]
        x ^= x >> _U(29)
        h += x * _GRAM_CODES[3 - j]
    h = mix64(h)
    # least hash, leftmost of equals, of 2, 4, 8, ... and then `span` successive grams
    best = (h & ~_POSITION) | np.arange(grams, dtype=_U)
    span, have = width - gram + 1, 1
    while have < span:
        shift = min(have, span - have)
        best = np.minimum(best[:-shift], best[shift:])
        have += shift
    pos = (best & _POSITION).astype(np.int64)
    size = np.diff(off)
    doc = np.repeat(np.arange(len(size)), size)[: len(pos)]
    start = np.flatnonzero(np.arange(len(pos)) + width <= off[1:][doc])
    if not len(start):
        return none.astype(_U), none, none, none, none
    pos, doc = pos[start], doc[start]
    new = np.flatnonzero(np.concatenate([[True], (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])]))
    return h[pos[new]], doc[new], start[new] - off[doc[new]], np.diff(np.append(new, len(start))), pos[new] - start[new]


def _cells(*columns: np.ndarray) -> np.ndarray:
    h = np.zeros(len(columns[0]), _U)
    for c in columns:
        h = mix64(h + c.astype(np.int64).view(_U) * _U(0xD6E8FEB86659FD93) + _U(1))
    return (h & _U(CELLS - 1)).astype(np.int64)


def bitmap(rows: DataFrame) -> np.ndarray:
    """Bitmap of the cells of the rows' columns, CELLS bits; put together in Spark, so the driver sees words of it."""
    names = rows.columns

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_cells(*(b.column(c).to_numpy(zero_copy_only=False) for c in names)))], names=["cell"])

    words = (rows.mapInArrow(cells, "cell long").groupBy(F.shiftright("cell", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")).toArrow())
    out = np.zeros(CELLS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(_U)


def _has(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 6] >> (cells & 63).astype(_U)) & _U(1) == 1


def _count_anchors(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, off in byte_slices(b.column("text").cast(pa.binary()), width):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(data, off, width, gram)[0].view(np.int64))], names=["h"])

    return run


def _find(width: int, gram: int, recurring, places=None):
    """Stretches of recurring anchors; with ``places`` those that begin at such a place, with their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, k1 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "k1"))
            for row, base, data, off in byte_slices(b.column("text").cast(pa.binary()), width):
                h, doc, first, n, at = anchors(data, off, width, gram)
                take = np.flatnonzero(_has(recurring.value, _cells(h.view(np.int64))))
                if places is not None and len(take):
                    take = take[_has(places.value, _cells(d[row[doc[take]]], k1[row[doc[take]]], base[doc[take]] + first[take]))]
                if not len(take):
                    continue
                h, doc, first, n, at = (x[take] for x in (h, doc, first, n, at))
                begin = off[doc] + first
                kind = Ranges(_BYTES[data], second=True)(begin, begin + n + width - 1)
                columns = [pa.array(h.view(np.int64)), pa.array(kind.view(np.int64)), pa.array(d[row[doc]]), pa.array(k1[row[doc]]),
                           pa.array(base[doc] + first), pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))]
                if places is not None:
                    raw = data.tobytes()
                    columns.append(pa.array([raw[i:j] for i, j in zip(begin.tolist(), (begin + n + width - 1).tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["h", "kind", *PLACE, "n", "at", "bytes"][: len(columns)])

    return run


def _finer(width: int, windows: int):
    """Cut stretches into blocks of ``windows`` successive windows, told by their distance from the anchor;
    the new anchor is the old one, the block and the bytes that all its windows cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("h", "kind", *PLACE, "n", "at", "bytes")}
            for r in b.to_pylist():
                at, text, i = r["at"], r["bytes"], 0
                while i < r["n"]:
                    block = (at - i) // windows
                    z = min(r["n"], at - block * windows + 1)  # the block's last window is that nearest the anchor
                    low = at - block * windows
                    core = text[low : low + width - windows + 1]
                    piece = text[i : z + width - 1]
                    key = hashlib.blake2b(b"%d %d " % (r["h"], block) + core, digest_size=8).digest()
                    for c, v in zip(out, (int.from_bytes(key, "little", signed=True),
                                          int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True),
                                          r["d"], r["k1"], r["start"] + i, z - i, at - i, piece)):
                        out[c].append(v)
                    i = z
            yield pa.RecordBatch.from_pydict({c: pa.array(v, _TYPES[c]) for c, v in out.items()})

    return run


_TYPES = {"h": pa.int64(), "kind": pa.int64(), "d": pa.int64(), "k1": pa.int64(), "start": pa.int64(), "n": pa.int32(), "at": pa.int32(), "bytes": pa.binary()}
_SPOT = "h long, kind long, d long, k1 long, start long, n int, at int"
_RANGE = "d long, k1 long, lo long, hi long"


def _mark(width: int) -> Callable[[pa.Table], pa.Table]:
    """One shard: index its stretches by place, stream them, and give the byte ranges of marked windows."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in PLACE])
        d, k1, start = (rows.column(c).to_numpy() for c in PLACE)
        # repeated rows of a table give the same place again
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (k1[1:] != k1[:-1]) | (start[1:] != start[:-1])])
        rows, d, k1, start = rows.filter(pa.array(new)), d[new], k1[new], start[new]
        blob = rows.column("bytes").combine_chunks().cast(pa.large_binary())
        off = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset : blob.offset + len(blob) + 1]
        index = RunIndex(np.frombuffer(blob.buffers()[2], np.uint8)[off[0] : off[-1]], off - off[0], width)
        text, lo, hi = [], [], []
        for i, at in enumerate(index.earlier()):
            if len(at):
                cut = np.flatnonzero(np.diff(at) != 1)
                text += [i] * (len(cut) + 1)
                lo += at[np.append(0, cut + 1)].tolist()
                hi += (at[np.append(cut, len(at) - 1)] + width).tolist()
        text = np.array(text, np.int64)
        return pa.table({"d": d[text], "k1": k1[text], "lo": start[text] + np.array(lo, np.int64), "hi": start[text] + np.array(hi, np.int64)})

    return run


def _held(spark: SparkSession, bits: np.ndarray):
    return spark.sparkContext.broadcast(bits)


def repeated_bytes(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, deal: int = DEAL, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``d``, ``k1`` and the byte range (``lo``, ``hi``) of windows that also start earlier, some of them
    overlapping, for ``texts`` (``d``: number that orders the documents, ``k1``: hash of the text, ``text``).
    Texts of equal ``d`` are ordered by ``k1``."""
    spark = texts.sparkSession
    again = texts.select("text").mapInArrow(_count_anchors(width, gram), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    recurring = _held(spark, bitmap(again.select("h")))
    spots = stage(texts.mapInArrow(_find(width, gram, recurring), _SPOT), "stretches", release=True)
    fetched, removed = None, []
    for windows in (*FINER, None):
        place = F.struct(*PLACE)
        kinds = stage(spots.groupBy("h", "kind").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("c"), F.first("n").alias("n")), "kinds")
        later = spots.join(kinds.where("c > 1").select("h", "kind", "p"), ["h", "kind"]).where(place > F.col("p"))
        removed.append(stage(later.select("d", "k1", F.col("start").alias("lo"), (F.col("start") + F.col("n") + (width - 1)).alias("hi")), "later-kinds", release=True))
        sizes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        several = stage(kinds.join(sizes, "h").select("h", "kind", "p.*", "n", "m"), "several-kinds", release=True)
        found = several.agg(F.sum(F.when(F.col("m") <= deal, F.col("n") + (width - 1))).alias("bytes"), F.max("m").alias("most")).first()
        if found["most"] is None:
            break
        if fetched is None:  # bytes are cut from the texts only now, where they are needed
            places = _held(spark, bitmap(several.select(*PLACE)))
            texts_of = texts.mapInArrow(_find(width, gram, recurring, places), _SPOT + ", bytes binary")
        else:
            texts_of = spots
        fetched = stage(texts_of.join(several.select("h", "kind", *PLACE, "m"), ["h", "kind", *PLACE]), "fetched", release=True)
        shards = max(1, -(-(found["bytes"] or 0) // shard_bytes))
        # shards of about equal size; an anchor is whole in one
        removed.append(stage(fetched.where(F.col("m") <= deal).select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), *PLACE, "bytes")
                             .groupBy("shard").applyInArrow(_mark(width), _RANGE), "marked", release=True))
        if found["most"] <= deal or windows is None:
            break
        spots = stage(fetched.where(F.col("m") > deal).drop("m").mapInArrow(_finer(width, windows), _SPOT + ", bytes binary"), "finer", release=True)
    out = removed[0]
    for r in removed[1:]:
        out = out.unionAll(r)
    return out


def _cut(width: int, digest: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, spans, out = [], [], [], []
            for text, copy, ranges in zip(b.column("text").cast(pa.binary()), b.column("copy").to_pylist(), b.column("ranges").to_pylist()):
                raw = text.as_py() or b""
                kept, at, cuts, end = [], 0, 0, -1
                for r in [{"lo": 0, "hi": len(raw)}] if copy and len(raw) >= width else ranges or ():
                    if r["lo"] > end:
                        kept.append(raw[at : r["lo"]])
                        cuts += 1
                    end = max(end, r["hi"])
                    at = end
                kept = b"".join([*kept, raw[at:]])
                size.append(len(raw))
                gone.append(len(raw) - len(kept))
                spans.append(cuts)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(x, pa.int64()) for x in (size, gone, spans)),
                                              pa.array(out, pa.string() if digest else pa.binary())], names=[*names, "_bytes", "_gone", "_spans", "_out"])

    return run


def remove_substrings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), digest: bool = False, width: int = WIDTH, **params) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_removed``, ``n_spans`` (runs removed) and the bytes kept (``kept``; with
    ``digest`` their SHA-256, ``kept_sha256``), for every row of ``docs``.

    Null and empty texts have no bytes; texts below ``width`` bytes stay whole. Null ids are before all others. Rows
    of equal id are documents of their own, ordered by a hash of their text; rows equal in both are
    ordered in any way, and all but one of them go. Cutting bytes can leave parts of a UTF-8 character. An empty table gives
    no rows. Columns of ``docs`` named like a result are replaced by it.
    """
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("d")
    key = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), F.col("text")).alias("k2")]
    long = docs.where(F.octet_length("text") >= width).select(d, *key, "text")
    held = long.groupBy("k1", "k2", "d").agg(F.count(F.lit(1)).alias("c"))
    first = F.min(F.struct("d", "c"))
    copied = stage(held.groupBy("k1", "k2").agg(first.alias("f"), F.sum("c").alias("n")).where("n > 1")
                   .select("k1", "k2", F.col("f.d").alias("first"), (F.col("f.c") > 1).alias("tied")), "copied-texts")
    few = copied.count() <= BROADCAST_TEXTS
    if few:  # else all copies are searched, with the same result
        long = long.join(F.broadcast(copied), ["k1", "k2"], "left").where(F.col("first").isNull() | (F.col("first") == F.col("d")))
    ranges = stage(repeated_bytes(long.select("d", "k1", "text"), width, **params).groupBy("d", "k1")
                   .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges")), "removed-ranges", release=True)

    rows = packed(docs, F.col("text"), d, *key, keep=keep)
    rows = rows.join(F.broadcast(copied) if few else copied, ["k1", "k2"], "left").withColumn("copy", F.coalesce(F.col("first") != F.col("d"), F.lit(False)))
    if not copied.where("tied").isEmpty():  # repeated rows: all but one are copies
        tied = F.coalesce(F.col("tied") & ~F.col("copy"), F.lit(False))
        number = F.row_number().over(Window.partitionBy("k1", "k2", "d").orderBy("d"))
        rows = rows.where(~tied).unionAll(rows.where(tied).withColumn("copy", number > 1))
    names = ["_row"]
    schema = StructType([rows.schema["_row"], *(StructField(c, LongType()) for c in ("_bytes", "_gone", "_spans")),
                         StructField("_out", StringType() if digest else BinaryType())])
    out = (rows.select("_row", "text", "d", "k1", "copy").join(ranges, ["d", "k1"], "left").select("_row", "text", "copy", "ranges")
           .mapInArrow(_cut(width, digest, names), schema))
    results = ("n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept")
    return unpacked(out, *[F.col(c).alias(n) for c, n in zip(("_bytes", "_gone", "_spans", "_out"), results)], replace=results)


def op12(docs: DataFrame) -> DataFrame:
    """Nulls, ties, repeated rows and empty tables: see ``remove_substrings``."""
    return remove_substrings(docs, digest=True)
