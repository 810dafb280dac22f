"""Quality rules with adaptive thresholds from mergeable quantile sketches.

One pass measures every text. A mergeable sketch of each measure is kept per language and source:
counts of logarithmic cells, which bound a quantile's relative error by ERROR and its size by the
range of the values. Sketches are added up to the language and to all documents, the same on every run;
a group with few documents (MIN_GROUP) borrows its language's threshold, or that of all. Thresholds are far-out fences around the
quartiles, so a homogeneous source loses nothing. They are joined back to the measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.common import stage
from shelfcast.llm.textops import Slice, grams, slices

#: A group's own sketch counts from this many documents on; a fence lies FENCE interquartile
#: ranges outside the quartiles; where the quartiles lie in one cell, the range below counts.
MIN_GROUP, FENCE = 200, 3.0
#: Relative width of a cell, by which a quantile may be off, and the cell of 0.
ERROR, ZERO = 0.0005, -(2**31)
#: measure -> range of a group without spread. Each measure is a share or a mean for which higher
#: is worse, so only upper fences are used.
RULES = {"symbol_share": 0.01, "dup_line_share": 0.05, "repeat_share": 0.05,
         "same_next_share": 0.02, "upper_share": 0.05, "mean_word": 0.5}
#: Texts with fewer words are too short for the sketches and for the adaptive rules.
MIN_WORDS = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True

SCHEMA = "_rid long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_same_next long, n_upper long"


def later_copies(doc: np.ndarray, code: np.ndarray, first_too: bool) -> np.ndarray:
    """Marks entries whose code was seen before in the same text (or is seen twice at all)."""
    order = np.lexsort((np.arange(len(code)), code, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (code[order][1:] == code[order][:-1])
    out = np.zeros(len(code), bool)
    out[order[1:]] = same
    if first_too:
        out[order[:-1]] |= same
    return out


def repeated_words(s: Slice, codes: np.ndarray, k: int = 8) -> np.ndarray:
    """Marks the words of ``k``-word windows that the same text holds twice or more."""
    at, h = grams(s, codes, k)
    hit = at[later_copies(np.searchsorted(s.woff, at, "right"), h, True)]
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + k, -1)
    return np.cumsum(cover)[: len(codes)] > 0


def measure(s: Slice) -> dict[str, np.ndarray]:
    """The counts of SCHEMA for each text of a slice."""
    by_text = lambda at: np.bincount(at, minlength=s.n).astype(np.int64)
    doc = s.doc_of_word()
    codes = s.word_hash()
    chars = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
    # lines: cut at each newline and at the ends of texts
    newline = np.flatnonzero(s.data == 10)
    line_start = np.sort(np.concatenate([s.off[:-1], newline + 1]), kind="stable")
    line_doc = np.searchsorted(np.sort(newline), s.off[:-1], "left")
    count = np.diff(np.concatenate([line_doc, [len(newline)]])) + 1
    line_doc = np.repeat(np.arange(s.n), count)
    stop = np.sort(np.concatenate([newline, s.off[1:]]), kind="stable")
    full = np.searchsorted(s.start, stop) > np.searchsorted(s.start, line_start)
    line_doc, line_start, stop = line_doc[full], line_start[full], stop[full]
    dup = later_copies(line_doc, s.range_hash(line_start, stop), False)
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1]))
    return {
        "n_words": np.diff(s.woff), "word_chars": np.bincount(doc, chars[s.end] - chars[s.start], s.n).astype(np.int64),
        "n_symbols": s.per_text(_SYMBOL[s.data]), "n_lines": by_text(line_doc), "n_dup_lines": by_text(line_doc[dup]),
        "n_repeat_words": by_text(doc[repeated_words(s, codes)]), "n_same_next": by_text(doc[same]),
        "n_upper": s.per_text(_UPPER[s.data]),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b.column("text")):
            yield pa.RecordBatch.from_pydict({"_rid": b.column("_rid").slice(s.first, s.n), **measure(s)})


def measures(docs: DataFrame) -> DataFrame:
    """One staged row per row of ``docs``: its other columns, the counts and the shares."""
    keyed = docs.select("doc_id", "lang", "source", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column("text")):
                own = {c: b.column(c).slice(s.first, s.n) for c in ("doc_id", "lang", "source")}
                yield pa.RecordBatch.from_pydict(own | {k: pa.array(v, pa.int64()) for k, v in measure(s).items()})

    kinds = dict(keyed.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", "lang", "source")) + ", " + SCHEMA.split(", ", 1)[1]
    m = keyed.mapInArrow(run, schema)
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    m = m.withColumns({
        "symbol_share": F.col("n_symbols") / chars, "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words, "same_next_share": F.col("n_same_next") / words,
        "upper_share": F.col("n_upper") / chars, "mean_word": F.col("word_chars") / words})
    return stage(m, "measures")


def cell_of(x: Column) -> Column:
    """The logarithmic cell of a value of 0 or more."""
    return F.when(x <= 0, F.lit(ZERO)).otherwise(F.ceil(F.log(x) / float(np.log1p(ERROR))).cast("int"))


def edge_of(cell: Column, upper: bool) -> Column:
    """The upper edge of a cell, or the lower."""
    return F.when(cell == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(1 + ERROR), cell if upper else cell - 1))


def thresholds(m: DataFrame, min_group: int = MIN_GROUP, fence: float = FENCE) -> DataFrame:
    """(lang, source) -> one upper threshold per rule, from merged sketches."""
    fit = m.where(F.col("n_words") >= MIN_WORDS)
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), cell_of(F.col(r)).alias("cell")) for r in RULES])).alias("x")
    cells = stage(fit.select("lang", "source", each).groupBy("lang", "source", "x.rule", "x.cell").agg(F.count(F.lit(1)).alias("n")), "sketches")

    def limits(by: list[str], mark: str) -> DataFrame:
        group = Window.partitionBy(*by, "rule")
        ranked = (cells.groupBy(*by, "rule", "cell").agg(F.sum("n").alias("n"))
                  .withColumn("total", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("cell"))))
        q = lambda part: F.min(F.when(F.col("upto") >= part * F.col("total"), F.col("cell")))
        least = F.create_map(*[F.lit(x) for pair in RULES.items() for x in pair])
        found = ranked.groupBy(*by, "rule").agg(q(0.25).alias("q1"), q(0.75).alias("q3"), F.max("total").alias("n"))
        # the outer edges: a fence is never nearer than that of the exact quartiles
        high, low = edge_of(F.col("q3"), True), edge_of(F.col("q1"), False)
        spread = F.when(F.col("q3") > F.col("q1"), high - low).otherwise(least[F.col("rule")])
        found = found.withColumn("limit", high + fence * spread)
        return found.groupBy(*by).agg(F.max("n").alias(f"{mark}_n"), *[F.max(F.when(F.col("rule") == r, F.col("limit"))).alias(f"{mark}_{r}") for r in RULES])

    own = limits(["lang", "source"], "own")
    lang = limits(["lang"], "lang").withColumnRenamed("lang", "lang_")
    every = limits([], "all").withColumn("one", F.lit(1))
    wide = (m.select("lang", "source").distinct().withColumn("one", F.lit(1)).alias("g")
            .join(own.alias("o"), F.col("g.lang").eqNullSafe(F.col("o.lang")) & F.col("g.source").eqNullSafe(F.col("o.source")), "left")
            .join(lang, F.col("g.lang").eqNullSafe(F.col("lang_")), "left").join(every, "one", "left"))
    best = [F.when(F.coalesce(F.col("own_n"), F.lit(0)) >= min_group, F.col(f"own_{r}"))
            .when(F.coalesce(F.col("lang_n"), F.lit(0)) >= min_group, F.col(f"lang_{r}"))
            .otherwise(F.col(f"all_{r}")).alias(f"max_{r}") for r in RULES]
    return wide.select(F.col("g.lang").alias("t_lang"), F.col("g.source").alias("t_source"), *best)


def quality_rules(docs: DataFrame, **params) -> DataFrame:
    """Measures, base verdict, thresholds and verdict of every row of ``docs``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated 8-word
    windows. ``kept``: not ``base_failed`` and no measure above its group's threshold. Null or
    empty texts have no words, so they fail. Null languages and sources are groups of their own.
    """
    m = measures(docs)
    t = thresholds(m, **params)
    joined = m.join(t, m["lang"].eqNullSafe(t["t_lang"]) & m["source"].eqNullSafe(t["t_source"]), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)


def op4(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept")
