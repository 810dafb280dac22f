"""The corpus operators against brute-force versions and worked cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shelfcast.llm import ctw, decontaminate, knn_quality, lines, mixing, near_dups, phrases, pii, preference, quality_rules
from shelfcast.llm.common import table
from shelfcast.llm.queries import ORACLE, QUERIES
from shelfcast.llm.textops import Ranges, grams, slices

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make(seed, n, words=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(words)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


# text primitives

def test_words_and_hashes():
    t = ["a b  c\td\n a b", None, "", "über  ñ x\x0b\x1cz ", "a", "b c a b"]
    (s,) = slices(pa.array(t))
    assert [[w.decode() for w in s.words(i)] for i in range(s.n)] == [WORD.findall(x or "") for x in t]
    h = s.word_hash()
    spelled = [s.data[a:b].tobytes() for a, b in zip(s.start, s.end)]
    assert len(set(h.tolist())) == len(set(spelled))
    at, g = grams(s, h, 2)
    pairs = [(spelled[i], spelled[i + 1]) for i in at]
    assert len(pairs) == 5 + 3 + 3 and len(set(g.tolist())) == len(set(pairs))


def test_slices_are_independent_of_their_size():
    t = pa.array([" ".join(make(i, 40)) for i in range(50)])
    one = np.concatenate([s.word_hash() for s in slices(t)])
    many = np.concatenate([s.word_hash() for s in slices(t, 300)])
    assert (one == many).all()


# op1

def luhn(d):
    return sum((int(c) if i % 2 == 0 else int(c) * 2 - (9 if int(c) > 4 else 0)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    regex = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, r in regex.items():
        for m in re.finditer(r, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base(spark, docs, texts):
    tricky = {9001: "a@b.c+d@e.f x@y a@b.c.d@e.fg", 9002: "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1 1.2.3", 9003: "ü\U0001F600 4111 1111-1111 1111, 41111111111111112",
              9004: "+1 (375) 555-4393 +12345678 +1+1 555 555 5555x", 9005: " ".join(["4111111111111111 x"] * 700), 9006: None,
              9007: "0.0.0.0 10.0.0.1 127.0.0.1, 1.2.3.00 000.0255.1.1 0256.1.1.1 " + "0" * 3000 + ".1.2.3"}
    extra = spark.createDataFrame([(k, v) for k, v in tricky.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.op1(docs.select("doc_id", "text").unionAll(extra)).collect()}
    for i, t in {**texts, **tricky}.items():
        want = base_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), i
        assert got[i]["n_card"] == sum(w.startswith("card") for w in want)
        assert set(want) <= set(filter(None, got[i]["spans"].split(",")))


def test_pii_discovers(spark):
    rows = [(i, f"{' '.join(make(i, 12))} call me at +1 (20{i}) 555-010{i} {' '.join(make(50 + i, 9))}") for i in range(6)]
    rows += [(20, f"{' '.join(make(70, 9))} call me at 555 0188 77 soon"), (21, f"{' '.join(make(71, 9))} w7 555 0188 78 w8"), (22, "call me at 10")]
    got = {r["doc_id"]: r for r in pii.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[6][1]
    at = text.index("555")
    assert got[20]["spans"] == f"phone:{at}:{at + 11}" and got[20]["n_added"] == 1 and got[20]["n_phone"] == 0
    assert got[21]["spans"] == got[22]["spans"] == "" and got[0]["n_added"] == 0


@pytest.mark.parametrize(("kind", "seed", "loose", "after"), [
    ("email", "joe{}@site.example", "bob[at]site.example", ", soon"), ("email", "joe{}@site.example", "bob(at)site.example", ""),
    ("email", "joe{}@site.example", "bob@localhost", ". Then"), ("ip", "10.1.7.1{}", "2001:db8::17", " soon"),
    ("ip", "10.1.7.1{}", "10[.]0[.]0[.]9", ", soon"), ("card", "411111111111111{}", "4111 1111 1111 1119", ". Then")])
def test_pii_discovers_each_kind(spark, kind, seed, loose, after):
    seeds = [t for t in map(seed.format, range(100)) if kind != "card" or luhn(t)][:6]
    rows = [(i, f"{' '.join(make(i, 12))} reach me at {t} {' '.join(make(50 + i, 9))}") for i, t in enumerate(seeds)]
    rows += [(20, f"{' '.join(make(70, 9))} reach me at {loose}{after}"), (21, f"{' '.join(make(71, 9))} w7 {loose}{after}")]
    got = {r["doc_id"]: r for r in pii.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    at = rows[-2][1].index(loose)
    assert got[20]["spans"] == f"{kind}:{at}:{at + len(loose)}" and got[20]["n_added"] == 1 and got[20][f"n_{kind}"] == 0
    assert got[21]["spans"] == "" and got[0]["n_added"] == 0 and got[0][f"n_{kind}"] == 1


# op2

def removed_by_force(texts, window=35):
    count, words = Counter(), {i: WORD.findall(t or "") for i, t in texts}
    for w in words.values():
        count.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_phrases(spark, docs, texts):
    p, r = make(1, 90), random.Random(4)
    extra = {1000 + i: " ".join(make(10 + i, r.randrange(60)) + p[r.randrange(40):40 + r.randrange(50)] + make(90 + i, r.randrange(60))) for i in range(60)}
    extra |= {2000: " ".join(p[:36] + ["x"] + p[36:75]), 2001: " ".join(p[:34]), 2002: "a b c " * 30, 2003: " ".join(p[5:50] + p[5:50])}
    near = make(5, 200)
    for i in range(25):
        copy = list(near)
        for _ in range(4):
            copy[r.randrange(200)] = f"z{r.randrange(3)}"
        extra[3000 + i] = " ".join(copy)
    df = docs.select("doc_id", "text").unionAll(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    want = removed_by_force([*texts.items(), *extra.items()])
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in phrases.remove_repeats(df).collect()}
    assert got == want


def test_phrases_of_a_frequent_anchor_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(phrases, "DEAL", 3)
    monkeypatch.setattr(phrases, "ANCHORS_A_SHARD", 2)
    p = make(2, 60)
    rows = [(i, " ".join(make(100 + i, 20) + p[i % 5:] + make(200 + i, 20))) for i in range(30)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in phrases.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == removed_by_force(rows)


# op3

def test_near_classes(spark):
    r, rows, truth = random.Random(8), [], {}
    for g in range(6):
        base = make(g, 300)
        for c in range(5):
            copy = list(base)
            for _ in range(c):
                copy[r.randrange(300)] = f"q{r.randrange(999)}"
            rows.append((g * 10 + c, " ".join(copy)))
            truth[g * 10 + c] = g * 10
    rows += [(100 + i, " ".join(make(500 + i, 250))) for i in range(30)]
    truth |= {100 + i: 100 + i for i in range(30)}
    got = {x["doc_id"]: x for x in near_dups.op3(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v["class_id"] for k, v in got.items()} == truth
    kept = near_dups.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(x["doc_id"] for x in kept) == sorted(set(truth.values()))


def test_star_of_copies_stays_one_class(spark):
    """Copies that are near the original only, not each other, hang together through it."""
    r, base = random.Random(3), make(77, 400)
    rows = [(50, " ".join(base))]
    for c in range(40):
        copy = list(base)
        for k in r.sample(range(0, 400, 10), 7):
            copy[k] = f"v{c}_{k}"
        rows.append((c, " ".join(copy)))
    got = near_dups.op3(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["class_id"] for x in got} == {0}


def test_links_of_a_template_group_against_brute_force(spark):
    """Texts from one template, some near each other and most not: classes against all pairs."""
    r, base, texts = random.Random(5), make(31, 220), []
    for _ in range(160):
        copy = list(base)
        for k in r.sample(range(0, 220, 6), r.choice((3, 5, 9, 14))):
            copy[k] = f"z{r.randrange(10**6)}"
        texts.append(copy)
        if r.random() < 0.3:
            texts.append([*copy[:-4], *make(r.randrange(999), 4)])
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = near_dups.inverse_frequencies(docs)
    (s,) = slices(pa.array(texts))
    h, w, off = near_dups.shingles(s, idf)
    own = [(h[off[i]:off[i + 1]], w[off[i]:off[i + 1]]) for i in range(len(texts))]
    comp = list(range(len(texts)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    links = [(i, j) for i in range(len(texts)) for j in range(i) if near_dups.weighted_jaccard(*own[i], *own[j]) >= near_dups.MIN_SIMILARITY]
    for i, j in links:
        comp[max(top(i), top(j))] = min(top(i), top(j))
    got = {x["doc_id"]: x["class_id"] for x in near_dups.op3(docs).collect()}
    assert all(top(i) == top(got[i]) for i in got)  # nothing is joined that should not be
    held = sum(got[i] == got[j] for i, j in links) / len(links)
    assert len(set(map(top, comp))) > 20 and held >= 0.95, held


def test_links_are_merged_into_known_components(spark):
    label = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "_rid long, comp long")
    links = spark.createDataFrame([(2, 6, 0.9), (8, 9, 0.9), (9, 10, 0.9)], "a long, b long, similarity double")
    got = {x["_rid"]: x["comp"] for x in near_dups.merged(label, links).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8, 10: 8}
    assert near_dups.merged(label, links.limit(0)) is label


def test_samples_estimate_the_similarity():
    idf = np.ones(1 << near_dups.CELL_BITS, np.float32)
    a = make(1, 600)
    agree, sims = [], []
    for k in range(30):
        b = a[: 400 + 6 * k] + make(900 + k, 200 - 6 * k)
        (s,) = slices(pa.array([" ".join(a), " ".join(b)]))
        h, w, off = near_dups.shingles(s, idf)
        x = near_dups.weighted_samples(h, w, off)
        agree.append((x[0] == x[1]).mean())
        sims.append(near_dups.weighted_jaccard(h[:off[1]], w[:off[1]], h[off[1]:], w[off[1]:]))
    assert abs(np.mean(agree) - np.mean(sims)) < 0.04


# op4

def test_quality_thresholds_against_brute_force(spark):
    """Fences within the stated error of the exact quartiles' ones; verdicts by them; the same on each run."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = quality_rules.quality_rules(docs, min_group=20).toPandas().sort_values("doc_id", ignore_index=True)
    again = quality_rules.quality_rules(docs, min_group=20).toPandas().sort_values("doc_id", ignore_index=True)
    assert first.equals(again)
    fit = first[first.n_words >= quality_rules.MIN_WORDS]
    over = np.zeros(len(first), bool)
    for rule, least in quality_rules.RULES.items():
        for i, row in first.iterrows():
            own = fit[(fit.lang == row.lang) & (fit.source == row.source)]
            lang = fit[fit.lang == row.lang]
            use = own if len(own) >= 20 else lang if len(lang) >= 20 else fit
            v = np.sort(use[rule].to_numpy())
            q1, q3 = (v[int(np.ceil(p * len(v))) - 1] for p in (0.25, 0.75))
            limit, e = row[f"max_{rule}"], quality_rules.ERROR
            exact = q3 + 3 * (q3 - q1)
            fence = exact - 1e-9 <= limit <= exact + 7 * q3 * e + 1e-9
            alike = q3 <= q1 * (1 + e) and abs(limit - (q3 + 3 * least)) <= q3 * e + 1e-9
            assert alike if q1 == q3 else fence or alike
            over[i] |= row[rule] > limit
    assert (first.kept == (~first.base_failed & ~over)).all()


def test_quality_measures(spark, docs, texts):
    got = {r["doc_id"]: r for r in quality_rules.op4(docs).collect()}
    for i, t in texts.items():
        w = WORD.findall(t)
        win = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        gone = set()
        for k in range(len(w) - 7):
            if win[tuple(w[k:k + 8])] > 1:
                gone.update(range(k, k + 8))
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(gone)), i
        assert r["base_failed"] == (len(w) < 20 or 100 * len(gone) > 30 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_verdict_follows_the_group(spark):
    """What is usual in one source fails in another."""
    plain = [(i, " ".join(make(i, 100)), "en", "plain", 0) for i in range(300)]
    tables = [(1000 + i, " ".join(f"{w} |" for w in make(i, 100)), "en", "tables", 0) for i in range(300)]
    odd = [(5000, " ".join(f"{w} |" for w in make(1, 100)), "en", "plain", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op4(spark.createDataFrame(
        plain + tables + odd, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not got.pop(5000) and all(got.values())


def test_quality_fences_are_the_groups_own(spark):
    """Against a source of plain lines: repeated lines, repeated passages (under 30 %), symbols and capitals,
    all below any cutoff that would suit every source."""
    plain = [(i, "\n".join(" ".join(make(100 * i + j, 10)) for j in range(10))) for i in range(300)]
    passage = " ".join(make(7, 10))
    odd = [(5000, plain[0][1] + "\n" + "\n".join([" ".join(make(1, 3))] * 4)),
           (5001, plain[0][1] + "\n" + "\n".join([passage + " x", passage + " y"])),
           (5002, plain[0][1] + " ########## ##########"), (5003, plain[0][1] + " " + "ABCDEFGHIJ" * 9)]
    rows = [(i, t, "en", "plain", 0) for i, t in plain + odd]
    got = {r["doc_id"]: r for r in quality_rules.op4(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == {i for i, _ in odd}


# op5

def test_common_prefix(spark):
    t = lambda *x: [{"role": r, "text": v} for r, v in x]
    a = t(("user", "q"), ("assistant", "one"), ("user", "more"), ("assistant", "two"))
    b = t(("user", "q"), ("assistant", "one"), ("user", "other"))
    kind = f"id int, chosen array<{preference.TURN}>, rejected array<{preference.TURN}>"
    rows = [(1, a, b), (2, a, a), (3, a, []), (4, None, b), (5, a, a[:2])]
    got = {r["id"]: r for r in preference.format_preferences(spark.createDataFrame(rows, kind)).collect()}
    assert [got[i]["prompt_turns"] for i in range(1, 6)] == [2, 4, 0, 0, 2]
    r = got[1]
    assert r["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\none<|end|>\n"
    lo, hi = map(int, r["chosen_mask"].split(":"))
    assert r["chosen_text"][lo:hi] == "two" and r["rejected_mask"] == "" and got[5]["rejected_text"] == ""


# op6

def test_water_fill():
    assert mixing.water_fill({"a": 10, "b": 100}, {"a": 5.0, "b": 1.0}, 100) == {"a": 20.0, "b": 80.0}
    t = mixing.water_fill({"a": 10, "b": 10, "c": 1000}, {"a": 5.0, "b": 2.0, "c": 1.0}, 1530)
    assert t == {"a": 20.0, "b": 20.0, "c": 1490.0}
    assert mixing.water_fill({}, {}, 0) == {}


def test_flow_prefers_single_copies():
    # the overlap serves y, so that x, which alone can take "only x", repeats as little as possible
    f = mixing.route({("x",): 10, ("x", "y"): 10, ("y",): 4}, {"x": 12, "y": 12})
    total = {p: sum(v.values()) for p, v in f.items()}
    assert total == {("x",): 10, ("x", "y"): 10, ("y",): 4}
    assert sum(v.get("x", 0) for v in f.values()) == 12 and sum(v.get("y", 0) for v in f.values()) == 12
    f = mixing.route({("x",): 10, ("y",): 10}, {"x": 15, "y": 5})
    assert f == {("x",): {"x": 15}, ("y",): {"y": 5}}


def test_mix_sums(spark, docs):
    for run in range(2):
        got = mixing.op6(docs).toPandas()
        if run:
            assert got.sort_values("doc_id").reset_index(drop=True).equals(first)
        first = got.sort_values("doc_id").reset_index(drop=True)
    own = {r["doc_id"]: r["source"] for r in docs.collect()}
    g = got.assign(source=got["doc_id"].map(own)).groupby("source").agg(t=("taken", "sum"), n=("size", "sum"), target=("target", "first"), s=("source_size", "first"), m=("size", "max"))
    assert (g.n == g.s).all() and (g.target <= 2 * g.s + 1e-6).all() and ((g.t - g.target).abs() <= g.m).all()
    assert abs(g.target.sum() - 1.5 * got["size"].sum()) < 1e-3 and (got["taken"] <= 2 * got["size"]).all()
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(set(own.values())))}
    free = g[g.target < 2 * g.s - 1e-6]
    unit = free.target / [weight[s] for s in free.index]
    assert unit.max() - unit.min() < 1e-6


def test_mix_of_overlapping_sources(spark):
    from pyspark.sql import functions as F
    rows = [(i, " ".join(make(i, 20)), m) for i, m in enumerate([["x"]] * 40 + [["x", "y"]] * 40 + [["y"]] * 40 + [[None]] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held array<string>")
    m = mixing.mix_sources(df, F.col("held"), F.lit(20), keep=("doc_id",)).collect()
    assert {tuple(r["_pat"]) for r in m} == {("0x",), ("0x", "0y"), ("0y",), ("1",)} and sum(r["_taken"] for r in m) == pytest.approx(1.5 * 3200, abs=20)


# op7

def test_leaks(spark):
    items = [(i, " ".join(make(i, 20 + 3 * i)) + ". " + " ".join(make(40 + i, 1 + i % 5)) + "?") for i in range(30)] + [(99, " ".join(make(99, 150)) + ".")]
    rows, want = [], set()
    for d in range(60):
        filler = make(1000 + d, 150)
        if d % 2:
            item = items[d // 2]
            filler[d * 2:d * 2] = item[1].upper().replace(" ", "  \n").split() if d % 3 else item[1].split()
            want.add((d, item[0]))
        rows.append((d, " ".join(filler)))
    rows.append((100, items[30][1]))
    want.add((100, 99))
    rows.append((101, items[3][1].split(". ")[0][:-80]))  # a part of a question alone
    got = decontaminate.op7(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_search_skips_nothing_above_threshold():
    """The block bounds find exactly what scoring every passage against every item finds."""
    items = [(i, " ".join(make(i, 12 + i % 30, 60))) for i in range(80)]
    shards = decontaminate.build(items)
    (s,) = slices(pa.array([" ".join(make(500 + i, 200, 60)) for i in range(20)]))
    codes = s.folded().word_hash()
    got = {(t, a, shard.items[j][0]) for shard in shards for t, a, j, _ in shard.search(codes, s.woff)}
    want = set()
    for shard in shards:
        for t in range(s.n):
            for a in range(s.woff[t], s.woff[t + 1], decontaminate.STRIDE):
                here = np.isin(shard.vocab, codes[a:min(a + 64, s.woff[t + 1])])
                score = shard.weight[here].sum(0)
                want |= {(t, a, shard.items[j][0]) for j in np.flatnonzero(score >= shard.need)}
    assert got == want and got


# op8

def test_classifier_on_held_out_labels(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    lab = table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in knn_quality.op8(d, lab).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    held = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in lab.collect() if got[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_vote():
    ref, y = np.eye(3, dtype=np.float32), np.array([1, 0, 1], np.float32)
    z = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 0]], np.float32)
    assert knn_quality.vote(z, ref, y, 0.25, 2).round(2).tolist() == [1, 0, 0.25]


# op10

def kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)


def weighted_by_force(pairs, node, depth, limit):
    """ln weighted probability of a decision node's context tree; pairs: (context nearest first, byte)."""
    own = [0, 0]
    bits = node.bit_length() - 1
    for _, b in pairs:
        if (b | 256) >> (8 - bits) == node:
            own[(b >> (7 - bits)) & 1] += 1
    own = kt(*own)
    if depth == limit:
        return own
    kids = sum(weighted_by_force([p for p in pairs if p[0][depth] == c], node, depth + 1, limit) for c in {p[0][depth] for p in pairs})
    return np.logaddexp(own, kids) + math.log(.5)


def test_weights_are_those_of_the_context_tree(spark, monkeypatch):
    monkeypatch.setattr(ctw, "KEEP", 1 << 40)  # every context is a node
    t = ["abab abba", "baba", "", "abc"]
    train = spark.createDataFrame([(i, x) for i, x in enumerate(t)], "doc_id long, text string")
    pairs = []
    for x in t:
        s = b"\xff" * 6 + x.encode() + b"\xff"
        pairs += [(s[k - 6:k][::-1], s[k]) for k in range(6, len(s))]
    hist = np.bincount([b for _, b in pairs], minlength=256)
    tree, nodes = ctw.grow_tree(train, int(hist.sum()), ctw.KEEP)
    pdf = nodes.toPandas()
    for near in {p[0][0] for p in pairs}:
        part, _ = ctw._subtree(pdf[[int(c) >> 8 * (d - 1) == near for c, d in zip(pdf["ctx"], pdf["depth"])]])
        own = [p for p in pairs if p[0][0] == near]
        for node in (1, 2, 3, 5, 6, 13):
            assert part.ln[0][0][node] == pytest.approx(weighted_by_force(own, node, 1, 6))
    tree, rows = ctw.train_model(train, hist, ctw.KEEP)
    assert np.allclose(np.exp2(rows.astype(float)).sum(1), 1, atol=1e-4)
    (s,) = slices(pa.array(t))
    assert (ctw.text_log2(tree, rows, s) < 0).all()


def test_language_model_base_and_gain(spark):
    """On 10,000 documents; on 1,000 the unigram base is still ahead, by 2 %."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in ctw.op10(docs).collect()}
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {i: [*WORD.findall(t.translate(low)), None] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


# the pipeline and the registered queries

def test_pipeline_stages_take_effect(spark, tmp_path):
    d, rows = "/root/testdata/sf0.01", table(spark, "/root/testdata/sf0.01", "documents")
    seen = [rows.count()]
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        rows = f(spark, rows, d)
        rows.write.parquet(f"{tmp_path}/{k}")
        rows = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(rows.count())
        if k == 2:
            left = [tuple(WORD.findall(r["text"])) for r in rows.collect()]
            assert len(left) == len(set(left))
        if k == 3:
            assert decontaminate.op7(rows, table(spark, d, "benchmark")).count() == 0
    assert seen[0] > seen[1] == seen[2] > seen[3] > seen[4] >= seen[5] > 0.5 * seen[0]


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)} and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    d = "/root/testdata/sf0.01"
    for t in ("pages", "conversations", "documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, d).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    order = lambda x: x[cols].convert_dtypes().astype(str).sort_values(cols).reset_index(drop=True)
    assert order(got).equals(order(want))
