"""Merkle manifest of a dataset in van Emde Boas layout.

Rows are leaves. The leaves of a group (a source) in key order form a tree: every ARITY successive
nodes of a level become their digest, until one node, the group's subroot, is left. The subroots in
group order form a tree of the same kind above them, up to the root.

* **Blocks.** An aligned subtree of LEVELS levels over ARITY**LEVELS leaves is a block. Blocks are
  built in parallel, each in a task of its own; their roots are the leaves of the next round, and so
  on up to one root. A group of any size is cut into blocks of bounded size.
* **Layout.** A block is one array of digests: it is cut at half its height, the top subtree is
  stored first, then the bottom subtrees from left to right, each laid out in the same way.
  ``address`` computes a node's place from its depth and number; nothing points anywhere. The
  nodes of a block of which only a beginning exists also lie at the beginning, so what is
  beyond the last one is not stored.
* **Proofs.** Siblings are read from the blocks by address, from the uppermost blocks down: a block
  needs its own array and the path of its root, which all its leaves share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import packed, stage, unpacked
from shelfcast.llm.ranking import numbered

ARITY = 16
#: Levels above the leaves that one block holds: 4,096 leaves and 140 kB at most.
LEVELS = 3
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------- layout

def tree_size(levels: int, arity: int = ARITY) -> int:
    """Nodes of a complete tree with so many levels of nodes."""
    return (arity**levels - 1) // (arity - 1)


@lru_cache(maxsize=256)
def _level_addresses(depth: int, levels: int, arity: int) -> np.ndarray:
    return address(depth, np.arange(arity**depth), levels, arity)


def address(depth: int, number: np.ndarray, levels: int, arity: int = ARITY) -> np.ndarray:
    """Place of the ``number``-th node at ``depth`` (root: 0) of a tree with ``levels`` levels of nodes."""
    if levels == 1:
        return np.zeros_like(number)
    top = levels // 2
    if depth < top:
        return address(depth, number, top, arity)
    below = arity ** (depth - top)  # nodes at this depth in one bottom subtree
    tree, inside = number // below, number % below
    return tree_size(top, arity) + tree * tree_size(levels - top, arity) + address(depth - top, inside, levels - top, arity)


def fold(digests: list[bytes]) -> bytes:
    """Digest of a run of nodes, taken as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height(n: int, arity: int = ARITY) -> int:
    """Levels above ``n`` leaves up to their single root."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def lay_out(leaves: list[bytes], levels: int, arity: int = ARITY) -> tuple[bytes, bytes]:
    """Root and array of a block with ``levels`` levels above its leaves."""
    rows, places = leaves, []
    for up in range(levels + 1):
        places.append((_level_addresses(levels - up, levels + 1, arity)[: len(rows)], rows))
        if up < levels:
            rows = [fold(rows[i : i + arity]) for i in range(0, len(rows), arity)]
    out = np.zeros((1 + max(int(at[-1]) for at, _ in places), DIGEST), np.uint8)
    for at, digests in places:
        out[at] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
    return rows[0], out.tobytes()


def siblings(layout: bytes, leaf: int, n: int, levels: int, arity: int = ARITY) -> list[tuple[int, list[bytes]]]:
    """(place in its run, the run's other digests) of a leaf and of its ancestors below the root of
    a block with ``n`` leaves."""
    out = []
    for up in range(levels):
        run = leaf // arity * arity
        at = address(levels - up, np.arange(run, min(run + arity, n)), levels + 1, arity).tolist()
        out.append((leaf - run, [layout[DIGEST * a : DIGEST * (a + 1)] for i, a in enumerate(at) if run + i != leaf]))
        leaf, n = leaf // arity, -(-n // arity)
    return out


def pack_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    """A path as bytes: for each level the place, the number of siblings and their digests."""
    return b"".join(bytes((at, len(others))) + b"".join(others) for at, others in path)


def unpack_path(data: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(data):
        at, k = data[i], data[i + 1]
        i += 2
        out.append((at, [data[i + DIGEST * j : i + DIGEST * (j + 1)] for j in range(k)]))
        i += DIGEST * k
    return out


def climb(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for at, others in path:
        digest = fold([*others[:at], digest, *others[at:]])
    return digest


# ---------------------------------------------------------------- construction

def _build(arity: int, levels: int):
    def run(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        n = nodes.column("n")[0].as_py()
        up = min(levels, height(n, arity))
        root, layout = lay_out(nodes.column("digest").to_pylist(), up, arity)
        return pa.table({"g": nodes.column("g").slice(0, 1), "block": nodes.column("block").slice(0, 1), "n": nodes.column("n").slice(0, 1),
                         "held": pa.array([len(nodes)], pa.int32()), "up": pa.array([up], pa.int32()),
                         "root": pa.array([root], pa.binary()), "layout": pa.array([layout], pa.binary())})

    return run


def build_blocks(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round, from the leaves up, and ``g``, ``digest`` of every group's root.

    ``nodes``: ``g`` (group, not null), ``pos`` (0, 1, ... in the group), ``n`` (leaves of the group),
    ``digest``. A block has ``g``, ``block`` (its number), ``n``, ``held`` (leaves), ``up`` (levels above
    them), ``root`` and ``layout``. A group of one node is its own root and has no block.
    """
    rounds, roots, size = [], None, arity**levels
    while True:
        done = nodes.where("n = 1").select("g", "digest")
        roots = done if roots is None else roots.unionAll(done)
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            return rounds, roots
        blocks = stage(nodes.withColumn("block", F.floor(F.col("pos") / size)).groupBy("g", "block").applyInArrow(
            _build(arity, levels), "g string, block long, n long, held int, up int, root binary, layout binary"), f"merkle-round-{len(rounds)}")
        rounds.append(blocks)
        nodes = blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("root").alias("digest"))


# ---------------------------------------------------------------- proofs

def _child_paths(arity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                paths = [pack_path(siblings(r["layout"], i, r["held"], r["up"], arity)) + r["path"] for i in range(r["held"])]
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array([r["g"]] * len(paths), pa.string()), "subroot": pa.array([r["subroot"]] * len(paths), pa.binary()),
                    "pos": pa.array(range(r["first"], r["first"] + len(paths)), pa.int64()), "path": pa.array(paths, pa.binary())})

    return run


def node_paths(rounds: list[DataFrame], above: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``g``, ``subroot``, ``pos`` and ``path`` of the leaves of the first of ``rounds`` (of the groups' roots, at
    ``pos`` 0, if there are none). ``above``: ``g``, ``subroot`` and ``path`` of the groups' roots."""
    columns = ["g", "subroot", "pos", "path"]
    paths = above.select("g", "subroot", F.lit(0).cast("long").alias("pos"), "path")
    for blocks in reversed(rounds):
        below = (blocks.select("g", F.col("block").alias("pos"), "held", "up", "layout", (F.col("block") * arity**levels).alias("first"))
                 .join(paths, ["g", "pos"]).select("g", "subroot", "first", "held", "up", "layout", "path")
                 .mapInArrow(_child_paths(arity), "g string, subroot binary, pos long, path binary").select(columns))
        # a group whose tree ends below this round hands its root's path down
        paths = below.unionAll(paths.where("pos = 0").join(blocks.select("g").distinct(), "g", "left_anti").select(columns))
    return paths


def _prove(arity: int, levels: int, names: list[str]):
    def run(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        above = unpack_path(block["path"])
        proofs, folded = [], []
        for pos, other in zip(rows.column("pos").to_pylist(), rows.column("other").to_pylist()):
            path = above
            if block["layout"] is not None:
                path = siblings(block["layout"], pos % arity**levels, block["held"], block["up"], arity) + above
            proofs.append(hashlib.sha256("".join(d.hex() for _, others in path for d in others).encode()).hexdigest())
            folded.append(climb(other, path).hex())
        return pa.table([*(rows.column(c) for c in names), pa.array([block["subroot"]] * len(rows), pa.binary()),
                         pa.array(proofs, pa.string()), pa.array(folded, pa.string())], names=[*names, "subroot", "proof", "folded"])

    return run


def digest_row(values: list[Column]) -> Column:
    """SHA-256 of a row, as hexadecimal text: each value is its byte count, ``:`` and its bytes, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def manifest(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), tampered: Column | None = None,
             arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``keep`` columns, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of every row.

    Sources are trees, their subroots the leaves of the tree above. ``tampered``: where it holds, the leaf that is
    folded with the siblings is that of the row with its text's A-Z lower-cased; elsewhere it is the row's own.

    Null sources form a source of their own, first in order; null ids come first in their source and are
    not tampered with by default. Rows of equal id are ordered by their leaf; equal rows are leaves
    of their own with equal digests. A null field differs from an empty one. A table of one row has its leaf
    as root and no siblings. An empty table gives no rows. Columns of ``docs`` named like a result are replaced by it.
    """
    if tampered is None:
        tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    values = {c: F.col(c) for c in FIELDS}
    other = digest_row([F.translate("text", _UPPER, _LOWER) if c == "text" else v for c, v in values.items()])
    leaves = stage(packed(docs, F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("g"), F.col("doc_id").alias("_id"),
                          F.unhex(digest_row(list(values.values()))).alias("digest"), F.when(tampered, F.unhex(other)).alias("other"), keep=keep),
                   "merkle-leaves")
    leaves = stage(numbered(leaves, ["g"], [F.asc_nulls_first("_id"), F.asc("digest")], "merkle-order"), "merkle-numbered")
    rounds, subroots = build_blocks(leaves.select("g", "pos", "n", "digest"), arity, levels)

    subroots = stage(subroots.select(F.lit("").alias("all"), "g", "digest"), "merkle-subroots")
    sources = stage(numbered(subroots, ["all"], [F.asc("g")], "merkle-source-order"), "merkle-sources")
    nodes = sources.select(F.col("all").alias("g"), "pos", "n", "digest")
    top_rounds, top = build_blocks(nodes, arity, levels)
    first = top.first()  # the root: one digest, or none for an empty table
    root = F.lit(first["digest"].hex() if first else None).cast("string")
    start = top.select("g", F.col("digest").alias("subroot"), F.lit(b"").alias("path"))
    above = (sources.select("pos", F.col("g").alias("source"), F.col("digest").alias("own"))
             .join(node_paths(top_rounds, start, arity, levels).select("pos", "path"), "pos")
             .select(F.col("source").alias("g"), F.col("own").alias("subroot"), "path"))

    # a block travels once, with the path of its root; a source of one row has a path but no block
    upper = node_paths(rounds[1:], stage(above, "merkle-source-paths"), arity, levels).withColumnRenamed("pos", "block")
    held = "held int, up int, layout binary"
    blocks = rounds[0].select("g", "block", "held", "up", "layout") if rounds else docs.sparkSession.createDataFrame([], f"g string, block long, {held}")
    names = ["_row", "digest"]
    rows = leaves.select("g", F.floor(F.col("pos") / arity**levels).alias("block"), "pos", *names, F.coalesce("other", "digest").alias("other"))
    schema = rows.select(*names).schema.add("subroot", "binary").add("proof", "string").add("folded", "string")
    out = (rows.groupBy("g", "block").cogroup(upper.join(blocks, ["g", "block"], "left").groupBy("g", "block"))
           .applyInArrow(_prove(arity, levels, names), schema))
    results = {"leaf": F.lower(F.hex("digest")), "subroot": F.lower(F.hex("subroot")), "root": root, "proof_sha256": F.col("proof"),
               "folded_root": F.col("folded"), "verified": F.col("folded") == root}
    return unpacked(out, *[c.alias(k) for k, c in results.items()], replace=tuple(results))


def op13(docs: DataFrame) -> DataFrame:
    """Nulls, ties, repeated rows and empty tables: see ``manifest``."""
    return manifest(docs)


def _op13_sql(levels: int = 6) -> str:
    """DuckDB oracle of ``op13``, level by level; good for ARITY**levels rows a source."""
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
           "lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)")
    field = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
    row = " || ".join(field.format(c) for c in FIELDS)
    parts = [f"""base as (
  select doc_id, coalesce('s' || source, 'n') as g, sha256({row}) as leaf,
    sha256({row.replace(field.format('text'), field.format("translate(text, '" + _UPPER + "', '" + _LOWER + "')"))}) as lower_leaf,
    coalesce({crc} % 5 = 0, false) as tampered
  from documents)""",
             "f0 as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, '' as proof, "
             "case when tampered then lower_leaf else leaf end as folded from base)",
             "n0 as (select g, pos, leaf as h, count(*) over (partition by g) as n from f0)"]

    def climb_levels(nodes: str, rows: str, key: str, out: str) -> tuple[str, str]:
        for i in range(levels):
            parts.append(f"{out}r{i} as (select {key}, pos // {ARITY} as run, list(h order by pos) as hs, any_value(n) as n from {nodes} where n > 1 group by 1, 2)")
            parts.append(f"{out}n{i} as (select {key}, run as pos, sha256(array_to_string(hs, '')) as h, (n + {ARITY - 1}) // {ARITY} as n from {out}r{i} "
                         f"union all select {key}, pos, h, n from {nodes} where n = 1)")
            parts.append(f"""{out}f{i} as (
  select f.* exclude (pos, proof, folded), case when r.hs is null then f.pos else f.pos // {ARITY} end as pos,
    proof || case when r.hs is null then '' else array_to_string(list_concat(r.hs[:f.pos % {ARITY}], r.hs[f.pos % {ARITY} + 2:]), '') end as proof,
    case when r.hs is null then folded else sha256(array_to_string(list_concat(list_append(r.hs[:f.pos % {ARITY}], folded), r.hs[f.pos % {ARITY} + 2:]), '')) end as folded
  from {rows} f left join {out}r{i} r on f.{key} = r.{key} and f.pos // {ARITY} = r.run)""")
            nodes, rows = f"{out}n{i}", f"{out}f{i}"
        return nodes, rows

    nodes, rows = climb_levels("n0", "f0", "g", "a")
    parts.append(f"subroots as (select g, h, row_number() over (order by g) - 1 as pos, 1 as one from {nodes})")
    parts.append("t0 as (select one, pos, h, count(*) over () as n from subroots)")
    parts.append(f"u0 as (select f.doc_id, f.leaf, s.h as subroot, f.proof, f.folded, s.pos, s.one from {rows} f join subroots s using (g))")
    top, last = climb_levels("t0", "u0", "one", "b")
    return "with " + ",\n".join(parts) + (
        f"\nselect doc_id, leaf, subroot, t.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = t.h as verified from {last} f join {top} t on f.one = t.one")


OP13_SQL = _op13_sql()
