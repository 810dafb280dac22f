"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

1. Words' document frequencies are counted over all documents, in 2**18 hashed cells (the size
   of that broadcast table is fixed). A shingle of five words weighs its term frequency times the
   mean inverse document frequency of its words, which is scaled to 1 (in every document) to 2.
2. One pass gives every different text BANDS x ROWS weighted samples (Ioffe's improved consistent
   weighted sampling), folded to one key a band. Two texts agree in a sample with the probability
   of their weighted Jaccard similarity. Texts that share a band key form a bucket.
3. The members of a bucket are compared with its hub, the member with most company in all its
   buckets. Verified pairs (weighted Jaccard of the whole texts at least MIN_SIMILARITY) join
   components. A bucket whose other members now lie in one component is done: its other pairs
   could join nothing.
4. The other members of buckets that are not done are dealt anew, by further independent samples
   into more bands of more rows (LEVELS): buckets shrink, and pairs below the similarity part. Each
   is compared with its bucket's hubs (those with most company, one of each slot of texts) unless
   the two lie in one component or were compared before. So each level compares a text a bounded
   number of times, however large a bucket is, and the pairs within a bucket are never formed.

   A pair of similarity s that nothing else joins meets in no bucket of a level of b bands of r
   rows with the probability (1 - s**r)**b: at 0.8 0.13 %, 0.24 % and 1.4 % at the three levels, at
   0.85 below 0.01 % at each.
5. The last level's buckets lose nothing: where their members that were no hubs still lie in several
   components, these are dealt to blocks of bounded size, and the texts of every two blocks of a bucket are
   compared with each other by one product of their shingle matrices. What a block leaves are the few pairs that
   join components, and those too close to the threshold to tell, which are verified like all others. So
   any two texts of such a bucket end up compared or in one component, and no rows are formed for pairs.
   On a table with a group of 1,500 texts whose similarities scatter around 0.8, comparing all
   pairs that share a bucket of the first level made 42,037 classes of 51,282 rows, this 42,038.
6. Each row gets the class of its text. Texts are known by 128 bits of their content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import packed, stage, unpacked
from shelfcast.llm.textops import Ranges, Slice, mix64, slices

SHINGLE, MIN_SIMILARITY = 5, 0.8
#: Bands, rows of a band and hubs of a bucket (slots) at each level of dealing.
LEVELS = ((10, 3, 1), (20, 6, 1), (60, 12, 4))
BANDS, ROWS = LEVELS[0][:2]
CELL_BITS = 18
#: Texts of a task that is dealing texts anew.
DEAL_TEXTS = 256
#: Candidate texts up to which their keys (24 bytes each) are broadcast to the scan that fetches them.
BROADCAST_TEXTS = 500_000
#: Texts and bytes of a block of an open bucket, and columns of a matrix of shingles.
BLOCK_TEXTS, BLOCK_BYTES, COLUMNS = 256, 1 << 23, 4096
#: Pairs this close to the least similarity are left to the verification, as sums differ in their last digits.
SLACK = 1e-5
KEY = ["k1", "k2"]
_U = np.uint64


def seeds_of(level: int) -> np.ndarray:
    """Two seeds for each sample of a level; levels are independent."""
    bands, rows, _ = LEVELS[level]
    return np.random.Generator(np.random.PCG64(99 + level)).integers(1, 2**63, (bands * rows, 2), dtype=np.uint64)


_SEEDS = seeds_of(0)


def word_cells(codes: np.ndarray) -> np.ndarray:
    return (codes >> _U(64 - CELL_BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each word cell, over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << CELL_BITS, np.int64), 0
        for b in batches:
            for s in slices(b.column("text")):
                pair = np.unique((s.doc_of_word() << CELL_BITS) | word_cells(s.word_hash()))
                df += np.bincount(pair & ((1 << CELL_BITS) - 1), minlength=1 << CELL_BITS)
                n += s.n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"cell": np.append(at, -1).astype(np.int32), "n": np.append(df[at], n)})

    got = docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = got.column("cell").to_numpy(), got.column("n").to_numpy()
    df = np.zeros(1 << CELL_BITS)
    df[cell[cell >= 0]] = n[cell >= 0]
    total = n[cell < 0].sum() + 1.0
    return (1 + np.log(total / (df + 1)) / max(np.log(total), 1e-9)).astype(np.float32)


def shingles(s: Slice, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, weight, and where each text's begin (and the end).

    A text of fewer than five words is one shingle; one without words has none.
    """
    codes = s.word_hash()
    size = np.diff(s.woff)
    count = np.where(size > 0, np.maximum(size - SHINGLE + 1, 1), 0)
    doc = np.repeat(np.arange(s.n), count)
    first = np.cumsum(count) - count
    at = np.arange(len(doc)) - first[doc] + s.woff[:-1][doc]
    end = np.minimum(at + SHINGLE, s.woff[1:][doc])
    h = Ranges(codes)(at, end)
    sums = np.concatenate([[0.0], np.cumsum(idf[word_cells(codes)], dtype=np.float64)])
    weight = (sums[end] - sums[at]) / np.maximum(end - at, 1)
    order = np.lexsort((h, doc))
    h, doc, weight = h[order], doc[order], weight[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(h)))
    return h[new], (weight[new] * tf).astype(np.float32), np.searchsorted(doc[new], np.arange(s.n + 1))


def _unit(bits: np.ndarray, shift: int) -> np.ndarray:
    """21 bits as a float in (0, 1)."""
    return ((bits >> _U(shift)) & _U(0x1FFFFF)).astype(np.float32) * np.float32(2.0**-21) + np.float32(2.0**-22)


def weighted_samples(h: np.ndarray, w: np.ndarray, off: np.ndarray, seeds: np.ndarray = _SEEDS) -> np.ndarray:
    """Consistent weighted samples: texts x seeds 64-bit values; 0 where a text has no shingle."""
    n = len(off) - 1
    out = np.zeros((n, len(seeds)), _U)
    full = np.flatnonzero(np.diff(off))
    if not len(full):
        return out
    begin, size = off[full], np.diff(off)[full]
    ln_w = np.log(w)
    owner = np.repeat(np.arange(len(full)), size)
    for k, (one, two) in enumerate(seeds):
        x = mix64(h ^ one)
        y = mix64(x + two)
        r = -np.log(_unit(x, 0) * _unit(x, 21))
        beta = _unit(x, 42)
        t = np.floor(ln_w / r + beta)
        ln_a = np.log(-np.log(_unit(y, 0) * _unit(y, 21))) - r * (t - beta + 1)
        least = np.minimum.reduceat(ln_a, begin)
        hit = np.flatnonzero(ln_a == least[owner])
        _, at = np.unique(owner[hit], return_index=True)
        hit = hit[at]
        out[full, k] = mix64(h[hit] + _U(0x9E3779B97F4A7C15) * t[hit].astype(np.int64).astype(_U))
    return out


def signatures(docs: DataFrame, idf, ids: list[str], level: int = 0) -> DataFrame:
    """The ``ids`` (longs) and ``bands``, the band keys of a level, of the texts that have words."""
    bands, rows, _ = LEVELS[level]
    seeds = seeds_of(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column("text")):
                samples = weighted_samples(*shingles(s, idf.value), seeds)
                keys = np.zeros((s.n, bands), _U)
                for i in range(rows):
                    keys = mix64(keys * _U(0xD6E8FEB86659FD93) + samples[:, i::rows] + np.arange(bands, dtype=_U))
                full = pa.array(np.diff(s.woff) > 0)
                own = pa.ListArray.from_arrays(pa.array(np.arange(s.n + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(s.first, s.n).filter(full) for k in ids), own.filter(full)],
                                                 names=[*ids, "bands"])

    return docs.select(*ids, "text").mapInArrow(run, ", ".join(f"{k} long" for k in ids) + ", bands array<long>")


def weighted_jaccard(h1, w1, h2, w2) -> float:
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    both = np.minimum(w1[i], w2[j]).sum(dtype=np.float64)
    return float(both / max(w1.sum(dtype=np.float64) + w2.sum(dtype=np.float64) - both, 1e-12))


def verified(pairs: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """The (a, b) pairs whose whole texts reach the similarity, with it."""
    t = lambda k: texts.select(F.col("_rid").alias(k), F.col("text").alias(f"{k}_text"))
    both = pairs.join(t("b"), "b").join(t("a"), "a").select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                b = batch.slice(i, 256)
                side = []
                for c in ("a_text", "b_text"):
                    side.append([(h[off[j]:off[j + 1]], w[off[j]:off[j + 1]]) for s in slices(b.column(c))
                                 for h, w, off in [shingles(s, idf.value)] for j in range(s.n)])
                sim = np.array([weighted_jaccard(*x, *y) for x, y in zip(*side)])
                ok = sim >= least
                yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok)), pa.array(sim[ok])],
                                                 names=["a", "b", "similarity"])

    return both.mapInArrow(run, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """_rid, comp: the least node reachable over the (a, b) links, for every node of a link.

    Least labels spread over the links, and each round also follows the label's own label, so
    rounds grow with the logarithm of a component's width.
    """
    both = stage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")), "label")
    while True:
        near = both.join(label.select(F.col("a").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        hop = label.join(near, "a").select("a", F.col("comp").alias("was"), F.least("comp", "near").alias("to"))
        up = label.select(F.col("a").alias("to"), F.col("comp").alias("top"))
        step = stage(hop.join(up, "to").select("a", "was", F.least("to", "top").alias("comp")), "label")
        changed = step.where("comp < was").limit(1).count()
        label = step.select("a", "comp")
        if not changed:
            return label.withColumnRenamed("a", "_rid")


def keyed(text: Column) -> list[Column]:
    """128 bits of a text's content, k1 and k2; null for a null text."""
    return [F.when(text.isNotNull(), F.xxhash64(text)).alias("k1"), F.when(text.isNotNull(), F.xxhash64(F.lit("second"), text)).alias("k2")]


def buckets(rep: DataFrame, name: str) -> DataFrame:
    """band, key, _rid, n of the members of buckets of two texts or more."""
    spread = rep.select("_rid", F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stage(spread.join(shared, ["band", "key"]), name)


def candidates(docs: DataFrame, rep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of shared buckets (band, key, _rid, company) and their texts."""
    near = buckets(rep, "buckets")
    company = near.groupBy("_rid").agg(F.sum("n").alias("company"))
    known = stage(rep.join(company, "_rid").select("_rid", *KEY, "company"), "candidates")
    members = stage(near.join(known.select("_rid", "company"), "_rid").select("band", "key", "_rid", "company"), "members")
    keys = known.select(*KEY)
    keys = F.broadcast(keys) if known.count() <= BROADCAST_TEXTS else keys
    texts = (docs.join(keys, KEY, "left_semi").groupBy(*KEY).agg(F.first("text").alias("text"))
             .join(known.select(*KEY, "_rid"), KEY).select("_rid", "text"))
    return members, stage(texts, "candidate-texts")


def merged(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components (_rid, comp) after new ``links``: only what they join is walked."""
    if label is None:
        return components(links)
    if links.isEmpty():
        return label
    of = lambda k: label.select(F.col("_rid").alias(k), F.col("comp").alias(f"{k}_comp"))
    over = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
    top = components(over).select(F.col("_rid").alias("comp"), F.col("comp").alias("top"))
    new = top.select(F.col("comp").alias("_rid"), F.col("top").alias("comp")).join(label, "_rid", "left_anti")
    return stage(label.join(top, "comp", "left").select("_rid", F.coalesce("top", "comp").alias("comp")).unionByName(new), "label")


def in_components(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """The members with their component, a text without links being its own."""
    if label is None:
        return members.withColumn("comp", F.col("_rid"))
    return members.join(label, "_rid", "left").withColumn("comp", F.coalesce("comp", "_rid"))


def not_done(members: DataFrame, hub: DataFrame, label: DataFrame) -> DataFrame:
    """band, key, _rid, comp of the members other than hubs of the buckets where those lie in several components."""
    own = hub.select("band", "key", F.col("hub").alias("_rid"))
    # read twice
    rest = stage(in_components(members.select("band", "key", "_rid").join(own, ["band", "key", "_rid"], "left_anti"), label), "others")
    open_ = rest.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return rest.join(open_.select("band", "key"), ["band", "key"], "left_semi")


def similarities(left: list, right: list) -> np.ndarray:
    """Weighted Jaccard similarities of two lists of texts (hashes and weights of their shingles), all with all."""
    n, both = len(left), [*left, *right]
    h, w = np.concatenate([x for x, _ in both]), np.concatenate([x for _, x in both]).astype(float)
    owner = np.repeat(np.arange(len(both)), [len(x) for x, _ in both])
    total = np.bincount(owner, w, len(both))
    order = np.argsort(h, kind="stable")
    h, w, owner = h[order], w[order], owner[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    first, column = np.flatnonzero(new), np.cumsum(new) - 1
    shared = (owner[first] < n) & (np.maximum.reduceat(owner, first) >= n)
    # a shingle as frequent in all texts that have it is a column of a product of matrices
    even = shared & (np.maximum.reduceat(w, first) <= np.minimum.reduceat(w, first) * (1 + 1e-6))
    overlap = np.zeros((n, len(right)))
    use = even[column]
    col, at, weight = (np.cumsum(even) - 1)[column[use]], owner[use], w[use]
    for c in range(0, int(even.sum()), COLUMNS):
        lo, hi = np.searchsorted(col, (c, c + COLUMNS))
        rows = np.zeros((len(both), COLUMNS))
        rows[at[lo:hi], col[lo:hi] - c] = np.where(at[lo:hi] < n, weight[lo:hi], 1.0)
        overlap += rows[:n] @ rows[n:].T
    end = np.append(first[1:], len(h))
    for t in np.flatnonzero(shared & ~even):
        i, x = owner[first[t]:end[t]], w[first[t]:end[t]]
        cut = np.searchsorted(i, n)
        overlap[np.ix_(i[:cut], i[cut:] - n)] += np.minimum.outer(x[:cut], x[cut:])
    return overlap / np.maximum(total[:n, None] + total[None, n:] - overlap, 1e-12)


def joining(sim: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that decide which components (``left``, ``right``) the similarities join: of those well above
    the least no more than join components, and those next to it unless the others join theirs."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for sure in (True, False):
        i, j = np.nonzero((left[:, None] != right) & (sim >= least + SLACK if sure else abs(sim - least) < SLACK))
        if sure:  # one pair for each two components
            _, k = np.unique(np.sort(np.stack([left[i], right[j]]), axis=0), axis=1, return_index=True)
            i, j = i[k], j[k]
        for a, b in zip(i.tolist(), j.tolist()):
            x, y = top(int(left[a])), top(int(right[b]))
            if x != y:
                out.append((a, b))
                if sure:
                    root[max(x, y)] = min(x, y)
    found = np.array(out, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def blocked(rest: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """The (a, b) pairs among the members of each bucket of ``rest`` that decide which of their components are joined."""
    sized = rest.join(texts.select("_rid", F.octet_length("text").alias("size")), "_rid")
    n = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_BYTES), F.lit(1)).cast("int")
    dealt = (rest.join(sized.groupBy("band", "key").agg(n.alias("n")), ["band", "key"])
             .withColumn("own", F.pmod(F.xxhash64("_rid", "key"), "n").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))))
    two = dealt.select("band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "_rid", "comp")

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        sets = [(h[off[j]:off[j + 1]], w[off[j]:off[j + 1]]) for c in t.column("text").chunks for s in slices(c)
                for h, w, off in [shingles(s, idf.value)] for j in range(s.n)]
        rid, comp, own = (t.column(c).to_numpy() for c in ("_rid", "comp", "own"))
        lo, hi = (np.flatnonzero(own == k.as_py()) for k in key[2:])
        a = b = np.zeros(0, np.int64)
        if len(lo) and len(hi):
            i, j = joining(similarities([sets[x] for x in lo], [sets[x] for x in hi]), comp[lo], comp[hi], least)
            a, b = rid[lo[i]], rid[hi[j]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return two.join(texts, "_rid").groupBy("band", "key", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def near_classes(docs: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """k1, k2, class: the class number of every different text of ``docs`` (k1, k2, text) that has
    words. An empty table gives no rows.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))
    rep = stage(signatures(docs, idf, KEY).groupBy(*KEY).agg(F.first("bands").alias("bands")).withColumn("_rid", F.monotonically_increasing_id()), "signatures")
    members, texts = candidates(docs, rep)
    label = tried = None
    for level, (_, _, hubs) in enumerate(LEVELS):
        if level:
            left = stage(not_done(members, hub, label).select("_rid").distinct(), "undone")
            n = left.count()
            if not n:
                break
            some = texts.join(left, "_rid", "left_semi").repartition(-(-n // DEAL_TEXTS))
            dealt = stage(signatures(some, idf, ["_rid"], level), "dealt")
            near = buckets(dealt, "buckets")
            members = near.join(near.groupBy("_rid").agg(F.sum("n").alias("company")), "_rid")
        members = stage(in_components(members, label), "members")
        best = F.max(F.struct("company", (-F.col("_rid")).alias("id"), "comp")).alias("h")
        slot = F.pmod(F.xxhash64("_rid", F.lit(level)), F.lit(hubs))
        hub = members.groupBy("band", "key", slot.alias("slot")).agg(best)
        hub = stage(hub.select("band", "key", (-F.col("h.id")).alias("hub"), F.col("h.comp").alias("hub_comp")), "hubs")
        pairs = (members.join(hub, ["band", "key"]).where("comp != hub_comp")
                 .select(F.least("_rid", "hub").alias("a"), F.greatest("_rid", "hub").alias("b")).distinct())
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        links = stage(verified(pairs, texts, idf, least), "verified")
        tried = pairs if tried is None else tried.unionAll(pairs)
        label = merged(label, links)
    else:
        rest = stage(not_done(members, hub, label), "rest")
        if not rest.isEmpty():
            pairs = stage(blocked(rest, texts, idf, least), "pairs")
            label = merged(label, stage(verified(pairs, texts, idf, least), "verified"))
    return rep.select("_rid", *KEY).join(label, "_rid", "left").select(*KEY, F.coalesce("comp", "_rid").alias("class"))


def op3(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class; of null ids only: null), class_size, for each row.

    Texts without words (null, empty, blank) are each a class of their own.
    """
    rows = docs.select("doc_id", *keyed(F.col("text")))
    classes = stage(near_classes(docs.where(F.col("text").isNotNull()).select(*keyed(F.col("text")), "text")), "near-classes")
    known = rows.join(classes, KEY, "left")
    of = known.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return known.join(of, "class", "left").select(
        "doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The first row, by doc_id, of each near-duplicate class, with all columns; null ids come
    last. Texts without words all stay."""
    field = F.col("_row").getField
    rows = stage(packed(docs, *keyed(F.col("text")), F.monotonically_increasing_id().alias("_rid")), "near-docs")
    classes = near_classes(rows.where(field("text").isNotNull()).select(*KEY, field("text").alias("text")))
    known = stage(rows.select("_rid", *KEY, field("doc_id").alias("doc_id")).join(classes, KEY).select("_rid", "doc_id", "class"), "near-classes")
    first = known.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_rid")).alias("o"))
    gone = known.select("_rid").join(first.select(F.col("o._rid").alias("_rid")), "_rid", "left_anti")
    return unpacked(rows.join(gone, "_rid", "left_anti"))
