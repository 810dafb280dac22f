"""Substring dedup: the run-length index and the operator against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import substrings
from shelfcast.llm.run_index import RunIndex

SCHEMA = "doc_id long, text string"


def index_of(texts, width):
    return RunIndex(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), width)


def mutated(r, base, n):
    out = []
    for _ in range(n):
        t = bytearray(base[(a := r.randint(0, 50)):a + r.randint(0, 40)])
        if t and r.random() < 0.5:
            t[r.randrange(len(t))] = r.choice(b"abz")
        out.append(bytes(t))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_run_index(seed):
    r = random.Random(seed)
    width = r.choice([3, 5, 8, 20])
    base = bytes(r.choices(b"ab\x00c", k=60))
    texts = mutated(r, base, r.randint(1, 8))
    index = index_of(texts, width)
    for j, (t, got) in enumerate(zip(texts, index.earlier())):
        assert got.tolist() == [i for i in range(len(t) - width + 1) if any(t[i:i + width] in u for u in texts[:j])]
    q = bytes(r.choices(b"abzc\x00", k=30)) + base[5:30]
    length, place = index.matching_statistics(np.frombuffer(q, np.uint8))
    for i in range(len(q)):
        most = max((n for n in range(len(q) - i + 1) if any(q[i:i + n] in u for u in texts)), default=0)
        assert length[i] == most
        assert bytes((index.symbol_text[place[i]:place[i] + most] - 1).astype(np.uint8)) == q[i:i + most]


def test_repetitive_texts_have_few_runs():
    r = random.Random(5)
    base = bytes(r.choices(b"abcdefgh ", k=400))
    texts = [base[:200] + bytes(r.choices(b"xyz", k=2)) + base[200:] for _ in range(50)]
    index = index_of(texts, 30)
    assert len(index.head) < 0.12 * index.n


def brute(rows, width):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by the contract, documents in order of id, null first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        t = (rows[i][1] or "").encode()
        gone = bytearray(len(t))
        for s in range(len(t) - width + 1):
            w = t[s:s + width]
            if w in seen:
                gone[s:s + width] = b"\x01" * width
            seen.add(w)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((rows[i][0], len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def check(spark, rows, width=100, **params):
    got = substrings.remove_substrings(spark.createDataFrame(rows, SCHEMA).repartition(3), width=width, **params).collect()
    key = lambda r: (r[0] is not None, *[x if x is not None else 0 for x in r])
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=key) == sorted(brute(rows, width), key=key)


def corpus(seed, n, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghü", k=r.randint(1, 8))) for _ in range(words)]
    say = lambda k: " ".join(r.choices(vocabulary, k=k))
    passages = [say(r.randint(10, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = " ".join(x for _ in range(r.randint(0, 5)) for x in (say(r.randint(0, 40)), r.choice(passages))) + say(r.randint(0, 9))
        rows.append((1000 - 3 * i, t))
    for i in range(n // 4):  # copies and near copies
        t = r.choice(rows)[1]
        rows.append((2000 + i, t if i % 2 else t.replace(r.choice(t.split() or ["a"]), "Q", 1)))
    return rows


def test_against_brute_force(spark):
    check(spark, corpus(1, 60))


def test_hot_anchor_is_cut_finer(spark):
    """A phrase in many surroundings: its anchors have more kinds than one deal, twice over."""
    r = random.Random(3)
    phrase = "the licence grants everyone the right to use copy and share this text in whole or in part without a fee of any kind"
    rows = [(i, "".join(r.choices("abcdef ", k=r.randint(0, 90))) + r.choice("xy") + phrase + r.choice(["!", "?"]) + "".join(r.choices("ghijk ", k=60))) for i in range(80)]
    check(spark, rows, deal=3, shard_bytes=4000)
    check(spark, corpus(9, 40), deal=1, shard_bytes=1000)


def test_edges(spark):
    r = random.Random(4)
    long = "".join(r.choices("abcdefgh ", k=9000))
    rows = [(None, "a" * 150), (None, None), (1, ""), (2, None), (3, "a" * 400), (4, "ü" * 120), (5, "x" + "ü" * 120), (6, long), (7, long), (8, long[500:] + "z"),
            (9, "\x00" * 130), (10, "short"), (11, "short")]
    check(spark, rows)


def test_repeated_rows_and_ids(spark):
    t, u = ("".join(random.Random(k).choices("abcdefgh ", k=300)) for k in (1, 2))
    rows = [(5, t)] * 3 + [(4, u), (4, u), (6, u)]
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in substrings.remove_substrings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(4, 0, 0), (4, 300, 1), (5, 0, 0), (5, 300, 1), (5, 300, 1), (6, 300, 1)]
    # two texts with one id: one of them keeps what both have
    got = substrings.remove_substrings(spark.createDataFrame([(1, t + u), (1, "x" + t)], SCHEMA)).collect()
    assert sum(r["n_removed"] for r in got) == 300


def test_pieces_of_long_texts(monkeypatch):
    """Every window of a text that is cut into pieces is in one stretch."""
    r = random.Random(6)
    t = "".join(r.choices("abcd ", k=5000)).encode()
    whole = substrings.anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
    monkeypatch.setattr(substrings, "PIECE", 700)
    starts = []
    for row, base, data, off in substrings.byte_slices(pa.array([t, None, b"x"]), 100):
        h, doc, first, n, at = substrings.anchors(data, off)
        starts += [int(base[d]) + int(f) + i for d, f, k in zip(doc, first, n) for i in range(k)]
    assert sorted(starts) == list(range(len(t) - 99)) and int(whole[3].sum()) == len(starts)


def test_digests_clashing_names_and_empty(spark):
    docs = spark.createDataFrame([(1, "a" * 250, "mine", "_"), (2, "b", "mine", "_")], "doc_id long, text string, kept string, d string")
    out = substrings.remove_substrings(docs, keep=("doc_id", "kept", "d", "text"))
    assert out.columns == ["doc_id", "d", "text", "n_bytes", "n_removed", "n_spans", "kept"]
    got = {r["doc_id"]: r for r in substrings.op12(docs).collect()}
    # 250 equal bytes: every window but the first starts earlier, so all but the first byte go
    assert (got[1]["n_removed"], got[1]["kept_sha256"]) == (249, hashlib.sha256(b"a").hexdigest())
    assert (got[2]["n_removed"], got[2]["kept_sha256"]) == (0, hashlib.sha256(b"b").hexdigest())
    assert substrings.op12(docs.limit(0)).count() == 0
