"""Importance resampling towards a target distribution.

1. **Weights.** Words are hashed into BUCKETS buckets by CRC-32. Bucket counts of the corpus and of
   the target texts give each bucket's gain, the logarithm of how much likelier the target has it;
   the gains are one array of fixed size that every scan task holds. A document's weight is the mean
   gain of its words, and its score that weight plus seeded Gumbel noise, so that the highest scores
   are a sample without replacement with probabilities by weight.
2. **Cutoff.** The score at which the sample ends is found by weighted median of medians. Each round
   every partition names the median of its keys still in question; their median, weighted by how many
   keys each partition has left, is the pivot. At least a quarter of the keys lie on either side
   of it, so a quarter is settled for good each round, until the pivot is the cutoff key itself.
   The driver sees one row a partition and round, never keys of the corpus.
3. **Winners**, the keys up to the cutoff, are sorted by ranges and numbered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.llm.common import packed, stage, unpacked
from shelfcast.llm.ranking import numbered
from shelfcast.llm.textops import Slice, lower_words, slices

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Bytes up to which words are hashed together, byte by byte; longer ones singly.
LONG_WORD = 48
KEY = ("a", "b", "c")
_MAX = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def word_crcs(s: Slice) -> np.ndarray:
    """CRC-32 of the bytes of every word of a slice."""
    size = s.end - s.start
    order = np.argsort(-size, kind="stable")
    start, size = s.start[order], size[order]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    crc = np.full(len(size), 0xFFFFFFFF, np.uint32)
    for j in range(int(size[long]) if long < len(size) else 0):
        k = int(np.searchsorted(-size, -j, "left"))  # words longer than j bytes
        c = crc[long:k]
        crc[long:k] = _CRC[(c ^ s.data[start[long:k] + j]) & 0xFF] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        crc[i] = zlib.crc32(s.data[start[i] : start[i] + size[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _bucket_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for s in slices(b.column("text")):
                n += np.bincount(word_crcs(lower_words(s)) % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Words of all texts by bucket; each task sends its sums, ``buckets`` rows at most."""
    rows = texts.select("text").mapInArrow(_bucket_counts(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded-down thousandths of the logarithm of target share over source share, each with one added to every bucket."""
    big_s, big_t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + k) / ((s + 1) * (big_t + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, w = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for s in slices(b.column("text")):
                lower_words(s)
                sums = np.concatenate([[0], np.cumsum(gain[word_crcs(s) % np.uint32(len(gain))])])
                words = np.diff(s.woff)
                n[s.first : s.first + s.n] = words
                w[s.first : s.first + s.n] = (sums[s.woff[1:]] - sums[s.woff[:-1]]) // np.maximum(words, 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "text"), pa.array(n), pa.array(w)],
                                             names=[*(c for c in b.schema.names if c != "text"), "_n", "_weight"])

    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate of each id, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# ---------------------------------------------------------------- the cutoff

_HALF = [f"{side}_{k}" for side in ("below", "above") for k in ("n", *KEY)]


def _medians(pivot: tuple[int, ...] | None):
    """For one partition: number and median of the keys below and above the pivot."""
    def side(a, b, c, inside):
        at = np.flatnonzero(inside)
        if not len(at):
            return [0, 0, 0, 0]
        mid = at[np.lexsort((c[at], b[at], a[at]))[(len(at) - 1) // 2]]
        return [len(at), int(a[mid]), int(b[mid]), int(c[mid])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(k).to_numpy(zero_copy_only=False) for k in KEY] for b in batches if b.num_rows]
        if not parts:
            return
        a, b, c = (np.concatenate(x) for x in zip(*parts))
        if pivot is None:
            below, above = np.ones(len(a), bool), np.zeros(len(a), bool)
        else:
            pa_, pb, pc = pivot
            below = (a < pa_) | ((a == pa_) & ((b < pb) | ((b == pb) & (c < pc))))
            above = (a > pa_) | ((a == pa_) & ((b > pb) | ((b == pb) & (c > pc))))
        row = [*side(a, b, c, below), *side(a, b, c, above)]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=_HALF)

    return run


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The least key that has half of all weight at or before it; ``medians``: (weight, key)."""
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def _after(key: tuple, at: tuple) -> Column:
    a, b, c = (F.col(k) for k in KEY)
    return (a > at[0]) | ((a == at[0]) & ((b > at[1]) | ((b == at[1]) & (c > at[2]))))


def nth_key(keys: DataFrame, n: int) -> tuple[int, int, int]:
    """The ``n``-th least (1, 2, ...) of the distinct keys (a, b, c), three longs compared in this order.

    ``keys`` should be a staged table, best sorted by key within its files: what is settled is then
    not read again.
    """
    low = high = pivot = None
    while True:
        left = keys.select(*KEY)
        # the first column alone bounds what is read; the whole key decides
        if low is not None:
            left = left.where(F.col("a") >= low[0]).where(_after(KEY, low))
        if high is not None:
            left = left.where(F.col("a") <= high[0]).where(~_after(KEY, high) & ~_same(high))
        rows = left.mapInArrow(_medians(pivot), ", ".join(f"{c} long" for c in _HALF)).collect()
        sides = {s: [(r[f"{s}_n"], tuple(r[f"{s}_{k}"] for k in KEY)) for r in rows if r[f"{s}_n"]] for s in ("below", "above")}
        below = sum(m for m, _ in sides["below"])
        if pivot is not None and n == below + 1:
            return pivot
        if n <= below:
            high, side = pivot, "below"
        else:
            low, side, n = pivot, "above", n - below - 1
        pivot = weighted_median(sides[side])


def _same(at: tuple) -> Column:
    return (F.col("a") == at[0]) & (F.col("b") == at[1]) & (F.col("c") == at[2])


def resample(docs: DataFrame, target: DataFrame, keep: tuple[str, ...] = ("doc_id",), percent: int = PERCENT,
             min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``keep`` columns, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    ``percent`` of the documents with at least ``min_words`` words are drawn, rounded down; ``rank`` is 1 for the highest score,
    null for a row that is not drawn. Equal scores go by smaller doc_id, null ids last, then in any fixed
    order. A null text has no words and weight 0; a null id draws the noise of an empty one. Repeated
    rows are documents of their own. A null or empty target leaves all gains to the corpus. An empty
    table gives no rows. Columns of ``docs`` named like a result are replaced by it.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = packed(docs, F.col("doc_id").cast("long").alias("_id"), F.col("text"), keep=keep)
    schema = StructType([f for f in rows.schema if f.name != "text"] + [StructField("_n", LongType()), StructField("_weight", LongType())])
    scored = rows.mapInArrow(_weigh(gain), schema).withColumn("_score", F.col("_weight") + gumbel(F.col("_id"), seed))
    # the row number of the table as written settles what score and id leave open
    scored = stage(scored.withColumns({"a": -F.col("_score"), "b": F.coalesce("_id", F.lit(_MAX)), "c": F.monotonically_increasing_id()})
                   .sortWithinPartitions("a"), "scored")
    drawn = F.col("_n") >= min_words
    size = scored.where(drawn).count() * percent // 100
    if size:
        cut = nth_key(scored.where(drawn), size)
        wins = drawn & ~_after(KEY, cut)
        # "all": one group; its ranges are sorted apart
        winners = numbered(scored.where(wins).select("_row", "_n", "_weight", "_score", *KEY, F.lit(0).alias("all")), ["all"], [F.asc(k) for k in KEY], "winners")
        result = (scored.where(~wins).select("_row", "_n", "_weight", "_score", F.lit(None).cast("long").alias("_rank"))
                  .unionAll(winners.select("_row", "_n", "_weight", "_score", F.col("pos") + 1)))
    else:
        result = scored.select("_row", "_n", "_weight", "_score", F.lit(None).cast("long").alias("_rank"))
    names = ("n_features", "weight", "score", "rank")
    return unpacked(result, *[F.col(c).alias(n) for c, n in zip(("_n", "_weight", "_score", "_rank"), names)], replace=names)


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Nulls, ties, repeated rows and empty tables: see ``resample``."""
    return resample(docs, benchmark)


#: DuckDB oracle of ``op11``. CRC-32 is taken of the distinct words alone, byte by byte.
OP11_SQL = rf"""
with w as (
  select 0 as side, row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as ws from documents
  union all
  select 1, row_number() over (), null, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') from benchmark),
words as (select side, r, unnest(ws) as word from w),
codes as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % {BUCKETS} as bucket
  from (select distinct word from words)),
counted as (
  select bucket, count(*) filter (where side = 0) as s, count(*) filter (where side = 1) as t from words join codes using (word) group by bucket),
totals as (select coalesce(sum(s), 0) as ss, coalesce(sum(t), 0) as tt from counted),
gain as (
  select bucket, floor(1000 * ln((t + 1)::double * (ss + {BUCKETS})::double / ((s + 1)::double * (tt + {BUCKETS})::double)))::bigint as g from counted, totals),
weighed as (
  select r, count(*) as n, floor(sum(g)::double / count(*))::bigint as weight from words join codes using (word) join gain using (bucket) where side = 0 group by r),
scored as (
  select w.r, w.doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(w.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from w left join weighed using (r) where w.side = 0),
ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last, r) as k, count(*) over () as n from scored where n_features >= {MIN_WORDS})
select doc_id, n_features::bigint as n_features, weight, score, case when k <= n * {PERCENT} // 100 then k end as rank
from scored left join ranked using (r)
"""
