"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import ctw, decontaminate, knn_quality, lines, mixing, near_dups, phrases, pii, preference, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BENCH = "item_id long, text string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghilmnoprstu", k=r.randint(2, 8))) for _ in range(n))


def edge_rows():
    long_text = prose(1, 30_000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b ", "en", "a", 5), (None, "no id here", "en", None, 10),
            (5, "x" * 200_000, "en", "a", 200_000), (6, long_text, "en", "b", len(long_text)), (7, "one", None, "b", 3),
            (8, "1 " * 5000, "en", "b", 10_000), (9, "a@" * 3000 + "b.c " + "+1(((" * 500, "en", "a", 1), (10, "ü" * 50 + " \U0001F600 z", "de", "a", 53)]
    rows += [(11, prose(2, 120), "en", "a", 1)] * 3 + [(12, prose(2, 120), "en", "b", 1)]
    return rows + [(20 + i, prose(20 + i, 60 + i), "en", "a" if i % 2 else "b", 1) for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark):
    # names that the operators use inside, and a result name of each
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    for name in ("_rid", "_row", "_h", "_host", "_lines", "score", "size", "taken", "kept_text", "n_words", "class", "h"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df.cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, prose(25, 40)), (2, None), (3, ""), (4, "too short"), (None, prose(77, 20))], BENCH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(20 + i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (21, None, 0), (20, 1, 1)], "doc_id long, quality int, toxic int")


OPS = {
    "op1": lambda d, b, l: pii.op1(d), "op2": lambda d, b, l: phrases.op2(d), "op3": lambda d, b, l: near_dups.op3(d),
    "op4": lambda d, b, l: quality_rules.op4(d), "op6": lambda d, b, l: mixing.op6(d),
    "op8": lambda d, b, l: knn_quality.op8(d, l), "op10": lambda d, b, l: ctw.op10(d),
}


@pytest.mark.parametrize("name", OPS)
def test_one_row_per_row(docs, bench, labels, name):
    got = OPS[name](docs, bench, labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in edge_rows())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r)
    if name == "op1":
        assert by[1]["spans"] == "" and by[2]["n_card"] == 0
    if name == "op2":
        assert (by[1]["n_words"], by[1]["n_removed"]) == (0, 0) and by[11]["n_removed"] == 120 and by[6]["n_removed"] == 0
        assert by[8]["n_removed"] == 5000  # windows of one text recur in it
    if name == "op3":
        assert by[11]["class_id"] == by[12]["class_id"] == 11 and by[12]["class_size"] == 4
        assert by[1]["class_id"] == 1 and by[2]["class_id"] == 2 and by[3]["class_id"] == 3
        assert by[None]["class_id"] is None
    if name == "op4":
        assert all(by[i]["base_failed"] and not by[i]["kept"] for i in (1, 2, 3, 5, 7))
        assert by[8]["n_repeat_words"] == 5000 and by[10]["word_chars"] == 52
    if name == "op6":
        assert by[1]["taken"] == 0 and by[1]["size"] == 0 and all(r["taken"] <= 2 * r["size"] for r in got)
    if name == "op8":
        assert all(0 <= r["score"] <= 1 for r in got) and by[1]["score"] == by[2]["score"]
    if name == "op10":
        assert by[1]["n_tokens"] == 1 and by[1]["score"] == by[2]["score"] < 0 and by[6]["n_tokens"] == 30_001


@pytest.mark.parametrize("name", OPS)
def test_empty_tables(spark, empty, name):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert OPS[name](empty, spark.createDataFrame([], BENCH), none).count() == 0


def test_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in knn_quality.op8(docs, none).collect()} == {0.5}


def test_repeated_items_and_rows(spark, docs, bench, empty):
    got = decontaminate.op7(docs, bench.unionAll(bench)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(25, 1), (25, 1)]
    assert decontaminate.op7(docs, spark.createDataFrame([], BENCH)).count() == 0
    assert decontaminate.op7(empty, bench).count() == 0
    # a benchmark beyond the broadcast bound is searched in rounds, with the same result
    assert sorted(r["doc_id"] for r in decontaminate.find_leaks(docs, bench, index_bytes=100).collect()) == [25]


@pytest.mark.parametrize("step", range(5))
def test_stages(spark, docs, labels, bench, tmp_path_factory, step):
    d = str(tmp_path_factory.mktemp("stage"))
    labels.write.parquet(f"{d}/labels.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    name, f = corpus_pipeline.STAGES[step]
    for table in (docs, docs.limit(0)):
        out = f(spark, table, d)
        if step < 4:
            assert out.columns == docs.columns and [x[1] for x in out.dtypes] == [x[1] for x in docs.dtypes]
            assert {r["class"] for r in out.select("class").collect()} <= {"own class"}
        else:
            assert [c for c in out.columns if c not in docs.columns] == ["source_size", "target"]
            assert dict(out.dtypes)["size"] == "bigint"
        n = out.count()
        assert n <= len(edge_rows()) and (step != 1 or n == table.count())


def test_page_lines(spark):
    page = "<html><body><ul><li>Menu</li></ul><p>own {}</p><script>var a='<p>x</p>';</script><!-- c --></body></html>"
    rows = [(i, "http://a.example/x", page.format(i)) for i in range(20)] + [(None, None, None), (5, "http://a.example/x", page.format(5)), (99, "ftp//bad", "")]
    out = {r["page_id"]: r for r in lines.op9(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3]["text"] == "own 3" and out[3]["n_dropped"] == 1 and out[3]["n_lines"] == 2
    assert out[99]["n_lines"] == 0 and out[None]["text"] == ""
    assert lines.op9(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_only_boilerplate_is_gathered(spark, tmp_path, monkeypatch):
    """40 lines stand on 5 of 100 pages each and one on 20: the arrays are gathered from that one alone."""
    rows = [(i, "http://a.example/x", f"<p>line {i % 20} a</p><p>line {i % 20} b</p>" + "<p>menu</p>" * (i < 20)) for i in range(100)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    gathered, stage = [], lines.stage

    def seen(df, name, *a, **k):
        if name == "site-lines":
            gathered.append(spark.read.parquet(*df.inputFiles()).count())
        return stage(df, name, *a, **k)

    monkeypatch.setattr(lines, "stage", seen)
    out = {r["page_id"]: r for r in lines.op9(spark.read.parquet(f"{tmp_path}/pages")).collect()}
    assert gathered == [1]
    assert out[3]["text"] == "line 3 a\nline 3 b" and sum(r["n_dropped"] for r in out.values()) == 20


def test_hosts(spark):
    urls = ["HTTP://U:p@A.example:80/x?y", "https://b.example", "nothing", None, "x://c.example#z"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(lines.host_of(F.col("u")).alias("h")).collect()
    assert [r["h"] for r in got] == ["a.example", "b.example", None, None, "c.example"]


def test_document_lines_keep_nulls(spark):
    rows = [(i, f"boiler\nown {i}\n\n", "en", "s", 1) for i in range(10)] + [(50, None, "en", "s", 0), (51, "boiler", None, None, 6)]
    out = {r["doc_id"]: r for r in lines.dedup_document_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[4]["text"] == "own 4\n\n" and out[4]["n_chars"] == 7
    assert out[50]["text"] is None and out[50]["n_chars"] is None and out[51]["text"] == "boiler"


def test_preference_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"),
            (3, 0, "user", None), (None, 0, "assistant", "x"), (5, None, None, None), (5, 1, "assistant", "\U0001F600!")]
    out = {r["conv_id"]: r for r in preference.op5(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(out) == [1, 2, 5]
    assert out[1]["prompt_turns"] == 2 and out[1]["chosen_text"] == out[1]["rejected_text"] == ""
    assert out[2]["prompt_turns"] == 2 and out[2]["chosen_mask"] == "14:15" and out[2]["rejected_text"] == ""
    assert out[5]["chosen_mask"] == "14:16" and out[5]["prompt"].startswith("<||>\n<|end|>")
    assert preference.op5(spark.createDataFrame([], schema)).count() == 0
