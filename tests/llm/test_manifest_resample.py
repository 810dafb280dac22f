"""Merkle manifest and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import manifest as M
from shelfcast.llm import resample as R
from shelfcast.llm.ranking import numbered
from shelfcast.llm.textops import lower_words, slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- manifest

@pytest.mark.parametrize("levels, arity", [(1, 4), (2, 3), (3, 2), (4, 3), (5, 2)])
def test_addresses(levels, arity):
    every = np.concatenate([M.address(d, np.arange(arity**d), levels, arity) for d in range(levels)])
    assert sorted(every.tolist()) == list(range(M.tree_size(levels, arity)))


def test_layout_keeps_subtrees_together():
    # 4 levels: the upper two are stored first, then each lower subtree in a row
    for tree in range(9):
        at = [*M.address(2, np.array([tree]), 4, 3), *M.address(3, np.arange(3 * tree, 3 * tree + 3), 4, 3)]
        assert at == list(range(4 + 4 * tree, 8 + 4 * tree))


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 10, 26, 27])
def test_siblings_climb_to_the_root(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    levels = M.height(n, 3)
    root, layout = M.lay_out(leaves, levels, 3)
    for i, leaf in enumerate(leaves):
        path = M.siblings(layout, i, n, levels, 3)
        assert M.climb(leaf, M.unpack_path(M.pack_path(path))) == root
        assert sum(len(others) for _, others in path) < 2 * levels + 1


def plain_manifest(rows, arity):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaves = []
    for doc_id, text, lang, source, n in rows:
        leaf = sha(*map(field, (doc_id, source, lang, n, text)))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaves.append([source, doc_id, leaf, sha(*map(field, (doc_id, source, lang, n, lower(text)))) if bad else leaf, ""])

    def tree(nodes):
        """Root of nodes: (digest, leaves below); the leaves' proofs and folded digests go along."""
        while len(nodes) > 1:
            up = []
            for i in range(0, len(nodes), arity):
                run = [d for d, _ in nodes[i:i + arity]]
                for j, (_, below) in enumerate(nodes[i:i + arity]):
                    for leaf in below:
                        leaf[4] += "".join(run[:j] + run[j + 1:])
                        leaf[3] = sha(*run[:j], leaf[3], *run[j + 1:])
                up.append((sha(*run), [x for _, below in nodes[i:i + arity] for x in below]))
            nodes = up
        return nodes[0]

    subroots = []
    for s in sorted({r[0] for r in leaves}, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted((r for r in leaves if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        subroots.append(tree([(r[2], [r]) for r in own]))
    sub = {id(leaf): d for d, below in subroots for leaf in below}
    root = tree(subroots)[0]
    return sorted((r[1] is not None, r[1] or 0, r[2], sub[id(r)], root, hashlib.sha256(r[4].encode()).hexdigest(), r[3], r[3] == root) for r in leaves)


def compare(spark, rows, arity, levels):
    out = M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), arity=arity, levels=levels).collect()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in out)
    assert got == plain_manifest(rows, arity)


def some_rows(n, sources):
    r = random.Random(n)
    return [(i, r.choice(["Text A", "lower", "", None, "ÄB"]) if i % 3 else f"T{i}", "en", sources[min(int(r.expovariate(1)), len(sources) - 1)], i) for i in range(n)]


def test_manifest_against_plain(spark):
    # blocks of one and two levels: several rounds for the large source, none for the small ones
    compare(spark, some_rows(150, ["a", None, "B", "é", ""]), 2, 2)
    compare(spark, some_rows(70, [f"s{i}" for i in range(12)]), 3, 1)
    compare(spark, some_rows(300, ["a", "b"]), 16, 3)


def test_manifest_edges(spark):
    compare(spark, [(1, "One", None, None, None)], 16, 3)
    # nulls, an empty field beside a null one, repeated rows and ids, a long text
    compare(spark, [(None, None, None, "a", None), (None, "", "", "a", 0), (5, "X", "en", "a", 1), (5, "X", "en", "a", 1), (5, "Y", "en", "a", 1),
                    (6, "Long " * 50_000, "en", "b", 1)], 2, 1)
    assert M.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, "t", "en", "s", 1, "mine", "g", "p")], SCHEMA + ", leaf string, g string, path string")
    out = M.manifest(clash, keep=("doc_id", "leaf", "g", "path"))
    assert out.columns == ["doc_id", "g", "path", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert (out.first()["g"], out.first()["path"], len(out.first()["leaf"])) == ("g", "p", 64)


def test_numbered(spark):
    rows = [("a" if i % 4 else "b", (i * 7) % 50) for i in range(100)]
    out = numbered(spark.createDataFrame(rows, "g string, v long"), ["g"], ["v"], "test", range_rows=9).collect()
    for g in "ab":
        own = sorted((r["pos"], r["v"], r["n"]) for r in out if r["g"] == g)
        values = sorted(v for h, v in rows if h == g)
        assert own == [(i, v, len(values)) for i, v in enumerate(values)]


# ---------------------------------------------------------------- resampling

def words_of(text):
    return [w for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]


def plain_resample(rows, target, percent, min_words, buckets):
    count = lambda texts: np.bincount([zlib.crc32(w) % buckets for t in texts for w in words_of(t)] or [0], minlength=buckets) - (0 if any(words_of(t) for t in texts) else np.eye(1, buckets, dtype=int)[0])
    s, t = count([r[1] for r in rows]), count(target)
    gain = [math.floor(1000 * math.log((int(y) + 1) * (int(s.sum()) + buckets) / ((int(x) + 1) * (int(t.sum()) + buckets)))) for x, y in zip(s, t)]
    out = []
    for doc_id, text in rows:
        ws = words_of(text)
        weight = sum(gain[zlib.crc32(w) % buckets] for w in ws) // len(ws) if ws else 0
        h = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        out.append([doc_id, len(ws), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return out


def test_word_crcs():
    texts = ["Ab c-d\x00é9 ", "", "x" * 300 + " y", None, "1,2;three " * 50]
    for s in slices(pa.array(texts)):
        got = R.word_crcs(lower_words(s)).tolist()
        assert got == [zlib.crc32(w) for t in texts for w in words_of(t)]


def same(spark, rows, target, percent=10, min_words=3, buckets=50):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = R.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, min_words=min_words, buckets=buckets).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((list(r) for r in got), key=key) == sorted(plain_resample(rows, target, percent, min_words, buckets), key=key)


def test_resample_against_plain(spark):
    r = random.Random(2)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(80)]
    say = lambda lo, hi: " ".join(r.choices(vocabulary, k=r.randint(lo, hi))).title()
    rows = [(i, say(0, 30)) for i in range(400)] + [(None, say(5, 9)), (401, None), (402, ""), (403, "w " * 20_000)]
    target = [" ".join(r.choices(vocabulary[:20], k=30)) for _ in range(10)] + [None, ""]
    same(spark, rows, target)
    same(spark, rows, target, percent=100)
    same(spark, rows, [], percent=37)
    same(spark, rows[:5], target)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(7, "one two three four")] * 30
    out = R.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "text string"), min_words=1, percent=50).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 16)) and len({r["score"] for r in out}) == 1
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none).count() == 0
    clash = spark.createDataFrame([(1, "a b c", "mine", "_")], "doc_id long, text string, score string, a string")
    out = R.resample(clash, none, keep=("doc_id", "score", "a"))
    assert out.columns == ["doc_id", "a", "n_features", "weight", "score", "rank"] and out.first()["a"] == "_"


@pytest.mark.parametrize("n", [1, 2, 77, 250, 499, 500])
def test_nth_key(spark, n):
    r = random.Random(8)
    keys = [(r.randint(-3, 3), r.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(keys, "a long, b long, c long").repartition(7).sortWithinPartitions("a")
    assert R.nth_key(df, n) == sorted(keys)[n - 1]


def test_pivots_settle_a_quarter():
    """Each round at least a quarter of the keys lie on either side of the weighted median of medians."""
    r = random.Random(1)
    for _ in range(50):
        parts = [sorted(r.sample(range(10**6), r.randint(1, 60))) for _ in range(r.randint(1, 12))]
        pivot = R.weighted_median([(len(p), p[(len(p) - 1) // 2]) for p in parts])
        every = [k for p in parts for k in p]
        assert sum(k <= pivot for k in every) >= len(every) / 4 and sum(k >= pivot for k in every) >= len(every) / 4
