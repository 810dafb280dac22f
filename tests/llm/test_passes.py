"""What an operator reads or parses more than once is written once."""

import collections

from shelfcast.llm import ctw, lines, phrases


def test_pages_are_parsed_once(spark):
    menu = "<li>Home</li><li>News</li>"
    rows = [(i, "http://site.org/p" if i % 2 else None, f"<body>{menu}<p>Text {i} of this page</p></body>") for i in range(20)] + [(None, None, None)]
    out = lines.op9(spark.createDataFrame(rows, "page_id long, url string, html string"))
    # the plan of the result holds no parsing: lines were written before they were counted
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["page_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
    assert got == {i: (f"Text {i} of this page", 3, 2) for i in range(20)} | {None: ("", 0, 0)}


def test_windows_are_counted_in_a_job_of_their_own(spark, monkeypatch):
    """The shuffle of all windows is over before the texts of phrases are gathered, so their files never add up."""
    plans = {}
    stage = phrases.stage

    def seen(df, name, *args, **kwargs):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name, *args, **kwargs)

    monkeypatch.setattr(phrases, "stage", seen)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} own{i}") for i in range(3)] + [(7, "a b c"), (8, None)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in phrases.op2(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (41, 40), 1: (41, 40), 2: (41, 40), 7: (3, 0), 8: (0, 0)}
    assert "bit_xor" in plans["twice"] and "bit_xor" not in plans["phrases"]


def test_contexts_are_counted_in_three_passes(spark, monkeypatch):
    """Six levels of contexts take three passes over the texts; every level's counts are those of all its occurrences."""
    passes = []
    count = ctw.level_counts
    monkeypatch.setattr(ctw, "level_counts", lambda train, tree, depth: passes.append(depth) or count(train, tree, depth))
    monkeypatch.setattr(ctw, "PIECE", 50)
    texts = ["abcab" * 30, "xyz " * 40, "", "aB c é" * 7]
    coded = [t.lower().encode() for t in texts]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    symbols = sum(len(t) + 1 for t in coded)
    tree, nodes = ctw.grow_tree(train, symbols, keep=symbols)  # every context is kept
    want = collections.Counter()
    for t in coded:
        line = b"\xff" * 6 + t + b"\xff"
        for i in range(6, len(line)):
            for d in range(1, 7):
                want[d, int.from_bytes(line[i - d:i][::-1], "big"), line[i]] += 1
    assert {(r["depth"], r["ctx"], r["byte"]): r["n"] for r in nodes.collect()} == dict(want)
    assert passes == [2, 4, 6]
