"""A boosted-tree model as data: node arrays that tasks walk.

A fitted ensemble becomes parallel arrays (feature, threshold, children, value). Tasks walk them for a batch of
rows at once, tree by tree and level by level, in Arrow functions over arrays of features. So a trained model
scores all forecast days of a request within the request's row, and the errors after every boosting round come
from one scan of the data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NODES = ("feature", "threshold", "left", "right", "value", "root", "weight")
#: Rows walked at a time: their features and places stay in a core's cache.
_ROWS = 4096
# The lines of a tree's description.
_IF = re.compile(r"^( *)If \(feature (\d+) <= (\S+)\)$")
_ELSE = re.compile(r"^( *)Else \(feature \d+ > \S+\)$")
_PREDICT = re.compile(r"^( *)Predict: (\S+)$")


@dataclass
class TreeEnsemble:
    """``inputs``: feature columns in order; ``nodes``: the arrays; ``depth``: longest walk."""

    inputs: list[str]
    nodes: dict[str, list]
    depth: int

    @classmethod
    def of(cls, model: PipelineModel) -> TreeEnsemble:
        """The trees of an assembler-and-trees pipeline, read from the model's own description, which states every
        number exactly. Splits are on ordered numbers (``training_pipeline`` declares no categories)."""
        forest = model.stages[-1]
        nodes: dict[str, list] = {c: [] for c in _NODES}

        def add(feature=-1, threshold=0.0, value=0.0) -> int:
            for c, v in (("feature", feature), ("threshold", threshold), ("left", -1), ("right", -1), ("value", value)):
                nodes[c].append(v)
            return len(nodes["feature"]) - 1

        for tree in forest.trees:
            nodes["root"].append(len(nodes["feature"]))
            open_: list[int] = []  # nodes that wait for a child
            for line in tree.toDebugString.splitlines()[1:]:
                if _ELSE.match(line):
                    continue
                if m := _IF.match(line):
                    at = add(int(m[2]), float(m[3]))
                elif m := _PREDICT.match(line):
                    at = add(value=float(m[2]))
                elif line.strip():
                    raise ValueError(f"not a split on an ordered number: {line.strip()!r}")
                else:
                    continue
                if open_:
                    above = open_[-1]
                    if nodes["left"][above] < 0:
                        nodes["left"][above] = at
                    else:
                        nodes["right"][above] = at
                        open_.pop()
                if nodes["feature"][at] >= 0:
                    open_.append(at)
        nodes["weight"] = [float(w) for w in forest.treeWeights]
        return cls(list(model.stages[0].getInputCols()), nodes, max((t.depth for t in forest.trees), default=0))

    def walker(self) -> Walker:
        return Walker(self.nodes, len(self.inputs), self.depth)

    def contributions(self, features: list[Column]) -> Column:
        """Array of every tree's weighted value for one row of features, in boosting order."""
        walker = self.walker()

        def run(rows: pa.Array) -> pa.Array:
            each = np.stack(list(walker.values(walker.matrix(rows))), 1) if walker.trees else np.zeros((len(rows), 0))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * walker.trees), pa.array(each.reshape(-1)))

        return F.arrow_udf(run, "array<double>")(F.array(*[f.cast("double") for f in features]))

    def prediction(self, features: list[Column]) -> Column:
        walker = self.walker()
        return F.arrow_udf(lambda rows: pa.array(walker.sums(walker.matrix(rows))), "double")(F.array(*[f.cast("double") for f in features]))

    def predictions(self, rows: Column) -> Column:
        """Array of predictions for an array of feature rows (each an array of doubles); null for null."""
        walker = self.walker()

        def run(rows: pa.Array) -> pa.Array:
            size = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            return pa.ListArray.from_arrays(ends, pa.array(walker.sums(walker.matrix(rows.flatten()))), mask=rows.is_null())

        return F.arrow_udf(run, "array<double>")(rows)


class Walker:
    """Walks all trees for a batch of rows. A missing or NaN feature goes right, as in the model."""

    def __init__(self, nodes: dict[str, list], width: int, depth: int):
        at = np.arange(len(nodes["feature"]))
        leaf = np.array(nodes["feature"], np.int64) < 0
        self.width, self.depth, self.trees = width, depth, len(nodes["root"])
        self.feature = np.where(leaf, 0, nodes["feature"]).astype(np.int64)
        self.threshold = np.array(nodes["threshold"], float)
        # right and left child of each node in turn; a leaf is its own
        self.child = np.where(leaf, at, np.stack([nodes["right"], nodes["left"]])).T.reshape(-1).astype(np.int64)
        self.value, self.root, self.weight = np.array(nodes["value"], float), nodes["root"], nodes["weight"]

    def matrix(self, rows: pa.Array) -> np.ndarray:
        """Feature rows (lists of doubles) as a matrix, NaN where a value is null."""
        return rows.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, self.width)

    def values(self, x: np.ndarray):
        """Each tree's weighted value of every row, tree by tree."""
        flat, base = np.ascontiguousarray(x).reshape(-1), np.arange(len(x)) * self.width
        for root, weight in zip(self.root, self.weight):
            at = np.full(len(x), root, np.int64)
            for _ in range(self.depth):
                at = self.child[2 * at + (flat[base + self.feature[at]] <= self.threshold[at])]
            yield self.value[at] * weight

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Every row's prediction, the trees added up in boosting order."""
        out = np.zeros(len(x))
        for i in range(0, len(x), _ROWS):
            for v in self.values(x[i:i + _ROWS]):
                out[i:i + _ROWS] += v
        return out


@dataclass
class TreeScorer:
    """Scores every forecast day inside the request row (as ``scoring.FeatureExpressionScorer`` does with a
    column function): no explode, no shuffle. ``features``: day of the forecast -> the model's features by name."""

    trees: TreeEnsemble
    features: Callable[[Column], dict[str, Column]]
    costly = True

    def predictions(self) -> Column:
        def day(i: Column) -> Column:
            values = self.features(F.date_add(F.col("date"), i))
            return F.array(*[values[c].cast("double") for c in self.trees.inputs])

        days = F.transform(F.sequence(F.lit(1), F.col("horizon").cast("int")), day)
        # an Arrow function runs for every row: rejected requests hand it nothing
        return self.trees.predictions(F.when(F.col("status").isNull(), days))


def rmse_per_round(model: PipelineModel, df: DataFrame, label: str) -> list[float]:
    """RMSE after each boosting round, all rounds from one scan: every row gives its squared error after each
    tree, and one aggregate averages them position by position."""
    trees = TreeEnsemble.of(model)
    rounds = len(trees.nodes["root"])
    y = F.col(f"`{label}`").cast("double")
    steps = trees.contributions([F.col(f"`{c}`") for c in trees.inputs])
    # running sums of the contributions, as squared errors
    state = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("errors"))
    walked = F.aggregate(steps, state, lambda s, v: F.struct(
        (s["sum"] + v).alias("sum"), F.concat(s["errors"], F.array((y - s["sum"] - v) * (y - s["sum"] - v))).alias("errors")))
    errors = df.select(walked["errors"].alias("e"))
    row = errors.agg(*[F.sqrt(F.avg(F.get("e", F.lit(i)))).alias(f"r{i}") for i in range(rounds)]).first()
    return [row[i] for i in range(rounds)]
