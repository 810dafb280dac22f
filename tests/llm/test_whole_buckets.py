"""Near-dedup leaves no pair of a last-level bucket undecided."""

import random

from shelfcast.llm import near_dups


def test_the_last_buckets_lose_no_link(spark, monkeypatch):
    """One level of wide buckets with one hub: chains of near copies, most links of which join no hub, still
    become the classes of all similar pairs."""
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for chain in range(6):
        words = shared + [f"c{chain}x{i}" for i in range(140)]
        for step in range(7):
            texts.append(" ".join(words))
            at = rng.randrange(60, 190)
            words = words[:at] + [f"n{chain}y{step}z{i}" for i in range(6)] + words[at + 6:]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = near_dups.inverse_frequencies(docs)
    own = []
    for t in texts:
        for s in near_dups.slices(__import__("pyarrow").array([t])):
            h, w, _ = near_dups.shingles(s, idf)
            own.append((h, w))
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_dups.weighted_jaccard(*own[i], *own[j]) >= near_dups.MIN_SIMILARITY:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    monkeypatch.setattr(near_dups, "LEVELS", ((40, 1, 1),))
    got = {r["doc_id"]: r["class_id"] for r in near_dups.op3(docs).collect()}
    assert got == {i: top(i) for i in range(len(texts))} and len(set(got.values())) < len(texts)


def test_open_buckets_form_no_pairs(spark, monkeypatch):
    """A bucket of texts just below the least similarity: all are compared, but few pairs become rows."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for t in range(150):
        words = list(base)
        for at in rng.sample(range(120), 6):
            words[at] = f"t{t}x{at}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    handed = []
    verified = near_dups.verified

    def counted(pairs, *rest):
        handed.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dups, "verified", counted)
    monkeypatch.setattr(near_dups, "LEVELS", ((40, 1, 1),))
    monkeypatch.setattr(near_dups, "BLOCK_TEXTS", 40)
    assert near_dups.op3(docs).select("class_id").distinct().count() > 100
    assert len(handed) > 1 and sum(handed) < 12 * len(texts)


def test_similarities_of_blocks():
    """Products of shingle matrices give the weighted Jaccard similarity of each pair, repeated shingles included."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(3)
    idf = np.linspace(1, 2, 1 << near_dups.CELL_BITS).astype(np.float32)
    words = [f"w{i}" for i in range(8)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(40)] + ["again and again and " * 30, "again and again and " * 12]
    sets = [(h[off[j]:off[j + 1]], w[off[j]:off[j + 1]]) for s in near_dups.slices(pa.array(texts))
            for h, w, off in [near_dups.shingles(s, idf)] for j in range(s.n)]
    got = near_dups.similarities(sets[:20], sets[20:])
    want = [[near_dups.weighted_jaccard(*a, *b) for b in sets[20:]] for a in sets[:20]]
    assert np.allclose(got, want, atol=near_dups.SLACK / 10)
    square = near_dups.similarities(sets, sets)
    assert np.allclose(np.diag(square), 1)
    # two components that a pair well above joins: one pair is enough
    sim = np.array([[1.0, 0.9, 0.81], [0.9, 1.0, 0.8], [0.81, 0.8, 1.0]])
    i, j = near_dups.joining(sim, np.array([1, 1, 2]), np.array([1, 1, 2]), 0.8)
    assert len(i) == 1 and {*i.tolist(), *j.tolist()} == {0, 2}
    i, j = near_dups.joining(np.array([[0.8 - 1e-7, 0.5]]), np.array([1]), np.array([2, 3]), 0.8)
    assert i.tolist() == j.tolist() == [0]
