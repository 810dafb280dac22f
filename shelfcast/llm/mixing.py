"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them). Word
capacity flows from patterns to source quotas; the k-th copy of a document costs k - 1, so a
repetition is used only where single copies cannot fill the quotas. The flow's amount per
pattern becomes whole copies of all its documents plus one more copy of a seeded part.

Only patterns and sources reach the driver (both are catalogue entries, not documents;
``max_patterns`` is checked). The seeded part is found with three histograms over a 64-bit
hash, so no task sorts a source.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.common import n_words, packed, stage, unpacked

CELL_BITS, BROADCAST_PATTERNS = 12, 20_000


def water_fill(sizes: dict, weights: dict, total: float, cap: float = 2.0) -> dict:
    """Split ``total`` by weight; a share stops at ``cap`` times its source's size and the
    excess is shared again by weight among the others, until none is above."""
    target, open_ = {}, dict(weights)
    left = float(total)
    while open_:
        unit = left / sum(open_.values())
        above = [s for s, w in open_.items() if unit * w > cap * sizes[s]]
        if not above:
            return target | {s: unit * w for s, w in open_.items()}
        for s in above:
            target[s] = cap * float(sizes[s])
            left -= target[s]
            del open_[s]
    return target


def route(patterns: dict[tuple, int], quotas: dict, max_copies: int = 2) -> dict[tuple, dict]:
    """Min-cost maximum flow from patterns to their sources' quotas.

    Cost sits only on the arcs that open a pattern's k-th copy and rises with k, so augmenting
    with copy 1 open, then with copy 2 open as well, and so on, is the successive-shortest-path
    order. Returns the words each pattern gives to each source.
    """
    flow: dict[tuple, dict] = {p: defaultdict(float) for p in patterns}
    need = {s: float(q) for s, q in quotas.items()}
    holders = defaultdict(list)
    for p in patterns:
        for s in p:
            holders[s].append(p)
    spare = dict.fromkeys(patterns, 0.0)
    for _ in range(max_copies):
        for p, size in patterns.items():
            spare[p] += float(size)
        while True:
            # breadth first from patterns with spare words to a source with open need; a source
            # that is full may hand back what another pattern gave it
            came: dict = {("p", p): None for p in patterns if spare[p] > 1e-9}
            queue, end = deque(came), None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    nexts = [("s", s) for s in x]
                else:
                    if need.get(x, 0.0) > 1e-9:
                        end = (kind, x)
                        break
                    nexts = [("p", p) for p in holders[x] if flow[p][x] > 1e-9]
                for y in nexts:
                    if y not in came:
                        came[y] = (kind, x)
                        queue.append(y)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min(spare[path[0][1]], need[end[1]],
                         *(flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "s"))
            spare[path[0][1]] -= amount
            need[end[1]] -= amount
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1]][b[1]] += amount
                else:
                    flow[b[1]][a[1]] -= amount
    return {p: dict(f) for p, f in flow.items()}


def _boundary(cells: DataFrame, cell: str, rest: str) -> DataFrame:
    """The cell of each pattern in which the running size passes what is still to be taken."""
    w = Window.partitionBy("_pat").orderBy(cell)
    upto = F.sum("_size").over(w)
    return (cells.withColumn("_upto", upto)
            .where((F.col("_upto") > F.col(rest)) & (F.col("_upto") - F.col("_size") <= F.col(rest)))
            .select("_pat", cell, (F.col(rest) - (F.col("_upto") - F.col("_size"))).alias(f"{rest}_in")))


def mix_sources(docs: DataFrame, members: Column, size: Column, weights=(5.0, 2.0, 1.0), total_share: float = 1.5,
                max_copies: int = 2, seed: int = 17, key: tuple[str, ...] = ("doc_id", "text"),
                max_patterns: int = 200_000, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``_row`` (a struct of the ``keep`` columns, default all), ``_pat`` (sources), ``_size``, ``_source_sizes``, ``_targets`` (maps by source) and
    ``_taken`` (words the mix takes of the row, repeats counted).

    ``members``: array of the sources that hold the row (null stands for a row without one; a
    null entry is the null source). ``size``: words of the row, null counts 0. Sources in code
    point order, null last, take ``weights`` in turn. ``key``: the columns that seed the choice;
    rows that agree in all of them are told apart by their position in the input.
    An empty table gives no rows. Rows of size 0 are taken 0 times.
    """
    rows = stage(packed(
        docs, F.array_sort(F.array_distinct(F.coalesce(members, F.array(F.lit(None).cast("string"))))).alias("_members"),
        F.coalesce(size, F.lit(0)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key]).alias("_h"),
        F.monotonically_increasing_id().alias("_rid"), keep=keep), "mix")

    # the null source becomes a marker that no name equals: names get a prefix
    mark = F.transform("_members", lambda m: F.when(m.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), m)))
    rows = rows.withColumn("_pat", F.array_sort(mark))
    found = rows.groupBy("_pat").agg(F.sum("_size").alias("n")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; aggregate sources before mixing")
    patterns = {tuple(r["_pat"]): int(r["n"]) for r in found}
    sizes: dict = defaultdict(int)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    order = sorted(sizes, key=lambda s: (s[0], s))  # Python orders strings by code point
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    targets = water_fill(sizes, weight, total_share * sum(patterns.values()), float(max_copies)) if order else {}
    flows = route(patterns, targets, max_copies)

    spark = docs.sparkSession
    plan = [(list(p), int(min(max_copies, sum(f.values()) // n)) if (n := patterns[p]) else 0) for p, f in flows.items()]
    plan = [(p, c, float(sum(flows[tuple(p)].values()) - c * patterns[tuple(p)])) for p, c in plan]
    plan_df = spark.createDataFrame(plan, "_pat array<string>, _copies long, _rest double")
    # tables of one row a pattern; their number is known, so the hint has a bound
    small = F.broadcast if len(plan) <= BROADCAST_PATTERNS else (lambda d: d)
    rows = rows.join(small(plan_df), "_pat")

    # three histograms of the seeded hash narrow the last partial copy down to one small cell
    top = F.shiftrightunsigned("_h", 64 - CELL_BITS).cast("int")
    mid = F.shiftrightunsigned("_h", 64 - 2 * CELL_BITS).bitwiseAND((1 << CELL_BITS) - 1).cast("int")
    rows = rows.withColumn("_c1", top).withColumn("_c2", mid)
    first = _boundary(rows.groupBy("_pat", "_rest", "_c1").agg(F.sum("_size").alias("_size")), "_c1", "_rest")
    inner = rows.join(small(first), ["_pat", "_c1"])
    second = _boundary(inner.groupBy("_pat", "_rest_in", "_c2").agg(F.sum("_size").alias("_size")), "_c2", "_rest_in")
    cell = inner.join(small(second), ["_pat", "_c2"])
    low = F.col("_h").bitwiseAND((1 << (64 - 2 * CELL_BITS)) - 1)
    w = Window.partitionBy("_pat").orderBy(low, "_rid").rowsBetween(Window.unboundedPreceding, 0)
    last = (cell.withColumn("_upto", F.sum("_size").over(w)).where(F.col("_upto") <= F.col("_rest_in_in"))
            .groupBy("_pat").agg(F.max(F.struct(low.alias("l"), F.col("_rid").alias("r"))).alias("_last"), F.max("_upto").alias("_got")))
    edge = stage(first.select("_pat", F.col("_c1").alias("_b1"))
                 .join(second.select("_pat", F.col("_c2").alias("_b2"), F.col("_rest_in_in").alias("_open")), "_pat", "left")
                 .join(last, "_pat", "left")
                 .withColumn("_gap", F.coalesce("_open", F.lit(0.0)) - F.coalesce("_got", F.lit(0))), "mix-edge")
    here = F.struct(low.alias("l"), F.col("_rid").alias("r"))
    extra = F.when(F.col("_rest") <= 0, F.lit(False)).when(F.col("_b1").isNull(), F.lit(True)).otherwise(
        (F.col("_c1") < F.col("_b1")) | ((F.col("_c1") == F.col("_b1")) & (
            (F.col("_c2") < F.col("_b2")) | ((F.col("_c2") == F.col("_b2")) & F.coalesce(here <= F.col("_last"), F.lit(False))))))
    out = rows.join(small(edge), "_pat", "left").withColumn("_extra", F.coalesce(extra, F.lit(False)))
    # the next row in order was too large: what is open goes to the row whose size is nearest to it
    off = F.abs(F.col("_size") - F.col("_gap"))
    close = stage(out.where(~F.col("_extra") & (off < F.col("_gap")))
                  .groupBy("_pat").agg(F.min(F.struct(off.alias("o"), F.col("_h").alias("h"), F.col("_rid").alias("r"))).alias("m"))
                  .select("_pat", F.col("m.r").alias("_closing")), "mix-close")
    out = out.join(small(close), "_pat", "left")
    extra = F.col("_extra") | F.coalesce(F.col("_rid") == F.col("_closing"), F.lit(False))
    pairs = lambda d: F.create_map(*[F.lit(x) for s in order for x in (s, float(d[s]))]) if order else F.create_map()
    copies = F.least(F.col("_copies") + extra.cast("long"), F.lit(max_copies))
    return out.select("_row", "_pat", F.col("_size"), pairs(sizes).alias("_source_sizes"),
                      pairs(targets).alias("_targets"), (F.col("_size") * copies).alias("_taken"))


def mix_documents(docs: DataFrame, keep: tuple[str, ...] | None = None, **params) -> DataFrame:
    """Mix a ``documents`` table whose rows each belong to their ``source``: the ``keep`` columns,
    size, source_size, target (of the row's source) and taken (words, repeats counted)."""
    m = mix_sources(docs, F.array("source"), n_words("text"), keep=keep, **params)
    own = F.element_at("_pat", 1)
    names = ("size", "source_size", "target", "taken")
    return unpacked(m, F.col("_size").alias("size"), F.element_at("_source_sizes", own).cast("long").alias("source_size"),
                    F.element_at("_targets", own).alias("target"), F.col("_taken").alias("taken"), replace=names)


def op6(docs: DataFrame) -> DataFrame:
    return mix_documents(docs, keep=("doc_id",))
