"""Regression forest grown level by level from shared histograms, held as flat arrays.

Bagging goes by key, not by partition: the weight of a row in a tree is a Poisson(1) number drawn from a hash of the row's
key and the tree. Labels are counted in fixed point, so every sum is exact whatever its order. The features a node may
split on are drawn from a hash of tree and node. The forest is therefore the same for any layout of the rows.

One Spark job grows one level of all trees: tasks send the sums by (tree, node, feature, bin), which are added up by
Spark, and the best splits of some trees are found in one task. Thresholds are the edges of an even grid of ``GRID`` cells at the
``BINS``-quantiles. What passes the driver is bounded by the model: its nodes, and ``GRID`` counts per feature.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# Python workers need only what Spark ships to them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = 1024
BINS = 32
# Labels are counted in steps of their range over this.
STEPS = 1 << 30


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of whole numbers, elementwise."""
    with np.errstate(over="ignore"):
        h = np.uint64(0)
        for part in parts:
            h = (h ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
    return h


def poisson_weights(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row stands in the sample of a tree."""
    chance = [math.exp(-1) / math.factorial(k) for k in range(16)]
    return np.searchsorted(np.cumsum(chance), mixed(keys, tree, seed) / 2.0**64, "right")


def node_features(nodes: np.ndarray, tree: int, seed: int, features: int, count: int) -> np.ndarray:
    """The features each node may split on, ascending."""
    order = mixed(nodes[:, None], tree, seed + 1, np.arange(features)).argsort(1, kind="stable")
    return np.sort(order[:, :count], axis=1)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): node 1 is the root, those below node i are 2i and 2i + 1; feature -1 is a leaf."""

    names: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees for rows of features; a missing feature goes left."""
        return walked(self.feature, self.threshold, self.value, x)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``."""
        shipped = df.sparkSession.sparkContext.broadcast((self.feature, self.threshold, self.value))

        @F.pandas_udf("double")
        def prediction(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            return pd.Series(walked(*shipped.value, x))

        return df.withColumn("prediction", prediction(*(F.col(name).cast("double") for name in self.names)))


def walked(feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, x: np.ndarray) -> np.ndarray:
    trees = np.arange(len(feature))[:, None]
    node = last_nodes(feature, lambda t, n, f: x[np.arange(len(x)), f] > threshold[t, n], len(x))
    return value[trees, node].sum(0) / len(feature)


def last_nodes(feature: np.ndarray, goes_right, rows: int) -> np.ndarray:
    """The node (tree, row) at which each row ends."""
    trees = np.arange(len(feature))[:, None]
    node = np.ones((len(feature), rows), np.int64)
    for _ in range((feature.shape[1] - 1).bit_length() - 1):
        at = feature[trees, node]
        right = goes_right(trees, node, np.maximum(at, 0))
        node = np.where(at >= 0, 2 * node + right, node)
    return node


def grid_thresholds(train: DataFrame, low: dict, high: dict, names: Sequence[str], rows: int) -> list[np.ndarray]:
    """Ascending thresholds per feature, at most ``BINS - 1``, the same for any layout of the rows."""
    cells = []
    for i, name in enumerate(names):
        span = F.lit(high[name] - low[name])
        cell = F.floor((F.col(name) - F.lit(low[name])) / span * GRID) if high[name] > low[name] else F.lit(0)
        cells.append(F.struct(F.lit(i).alias("i"), F.least(cell, F.lit(GRID - 1)).cast("int").alias("cell")))
    counts = train.select(F.explode(F.array(*cells)).alias("at")).groupBy("at.i", "at.cell").count().toPandas()
    out = []
    for i, name in enumerate(names):
        mine = counts[counts["i"] == i].sort_values("cell")
        upto = mine["count"].cumsum().to_numpy() * BINS
        at = np.unique(np.searchsorted(upto, rows * np.arange(1, BINS), "left"))
        edge = mine["cell"].to_numpy()[at]
        edge = edge[edge < mine["cell"].max()] if len(mine) else edge
        out.append(low[name] + (edge + 1) * (high[name] - low[name]) / GRID)
    return out


SUMS = "tree int, node long, feature int, bin int, weight long, total long"
SPLITS = "tree int, node long, feature int, bin int, gain double, weight_left long, total_left long, weight_right long, total_right long"


def level_sums(rows: DataFrame, plan: dict, open_nodes: dict[int, np.ndarray]) -> DataFrame:
    """Weights and label sums by (tree, node, feature, bin) over the rows of all open nodes."""
    shipped = rows.sparkSession.sparkContext.broadcast((plan, open_nodes))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, open_nodes = shipped.value
        names, bins, seed = plan["names"], BINS, plan["seed"]
        held = {}
        for part in parts:
            x = part[names].to_numpy(np.float64)
            binned = np.column_stack([np.searchsorted(t, x[:, i], "left") for i, t in enumerate(plan["thresholds"])])
            label = np.rint((part["label"].to_numpy() - plan["low"]) / plan["span"] * STEPS).astype(np.int64)
            keys, here = part["key"].to_numpy(), np.arange(len(part))
            at = last_nodes(plan["feature"], lambda t, n, f: binned[here, f] > plan["split"][t, n], len(part))
            for tree, nodes in open_nodes.items():
                weight = poisson_weights(keys, tree, seed) if plan["bootstrap"] else np.ones(len(part), np.int64)
                place = np.minimum(np.searchsorted(nodes, at[tree]), len(nodes) - 1)
                used = (weight > 0) & (nodes[place] == at[tree])
                place, weight, mine = place[used], weight[used], binned[used]
                asked = node_features(nodes, tree, seed, len(names), plan["count"])
                if tree not in held:
                    held[tree] = asked, np.zeros((2, len(nodes) * plan["count"] * bins), np.int64)
                sums = held[tree][1]
                for j in range(plan["count"]):
                    index = (place * plan["count"] + j) * bins + mine[np.arange(len(mine)), asked[place, j]]
                    np.add.at(sums[0], index, weight)
                    np.add.at(sums[1], index, weight * label[used])
        for tree, (asked, sums) in held.items():
            some = np.flatnonzero(sums[0])
            place, j, bin_ = some // (plan["count"] * bins), some // bins % plan["count"], some % bins
            yield pd.DataFrame(
                {"tree": tree, "node": open_nodes[tree][place], "feature": asked[place, j], "bin": bin_, "weight": sums[0][some], "total": sums[1][some]}
            )

    partial = rows.select("key", "label", *plan["names"]).mapInPandas(run, SUMS)
    return partial.groupBy("tree", "node", "feature", "bin").agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))


# Trees whose splits are found in one task, and nodes looked at together there.
TASK_TREES, TASK_NODES = 16, 2048


def best_splits(sums: pd.DataFrame) -> pd.DataFrame:
    """The best split of each node of some trees, ``TASK_NODES`` nodes at a time."""
    sums = sums.sort_values(["tree", "node"])
    tree, node = sums["tree"].to_numpy(), sums["node"].to_numpy()
    first = np.flatnonzero(np.append(True, (np.diff(tree) != 0) | (np.diff(node) != 0)))
    ends = [*first[::TASK_NODES].tolist(), len(sums)]
    return pd.concat([node_splits(sums.iloc[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)])


def node_splits(sums: pd.DataFrame) -> pd.DataFrame:
    """The split of each node that lowers the squared error most; ties go to the first feature, then bin."""
    pairs, place = np.unique(sums[["tree", "node"]].to_numpy(), axis=0, return_inverse=True)
    trees, nodes = pairs.T
    features = int(sums["feature"].max()) + 1
    dense = np.zeros((2, len(nodes), features, BINS), np.int64)
    for k, name in enumerate(("weight", "total")):
        np.add.at(dense[k], (place, sums["feature"].to_numpy(), sums["bin"].to_numpy()), sums[name].to_numpy())
    left = dense.cumsum(3)
    right = left[:, :, :, -1:] - left
    ok = (left[0] > 0) & (right[0] > 0)
    score = [s[1].astype(float) * s[1].astype(float) / np.maximum(s[0], 1) for s in (left, right)]
    score = np.where(ok, score[0] + score[1], -np.inf).reshape(len(nodes), -1)
    best = score.argmax(1)
    # Every feature that a node was asked for sums to the whole node.
    whole = left[:, :, :, -1].transpose(0, 2, 1)
    first = whole[0].argmax(0)
    weight, total = (w[first, np.arange(len(nodes))] for w in whole)
    gain = score[np.arange(len(nodes)), best] - total.astype(float) * total / weight
    picked = np.arange(len(nodes)), best // BINS, best % BINS
    split = gain > 1e-12 * np.maximum(total.astype(float) * total / weight, 1)
    sides = {f"{name}_{side}": s[k][picked] for side, s in (("left", left), ("right", right)) for k, name in enumerate(("weight", "total"))}
    # Nodes that stay leaves are told with their whole sum, as the left side.
    sides = {name: np.where(split, v, {"weight_left": weight, "total_left": total}.get(name, 0)) for name, v in sides.items()}
    return pd.DataFrame({"tree": trees, "node": nodes, "feature": np.where(split, picked[1], -1), "bin": picked[2], "gain": gain, **sides})


def grow_forest(
    train: DataFrame, names: Sequence[str], key: Sequence[str], trees: int, depth: int, seed: int, bootstrap: bool = True, subset: str = "auto"
) -> Forest:
    """Grow a forest on ``train`` (label, features, key columns), a stored table without NULLs.

    ``subset``: features per split, ``all`` or ``auto`` (a third of them when there are several trees).
    """
    names = list(names)
    count = len(names) if subset == "all" or trees == 1 else math.ceil(len(names) / 3)
    ends = train.agg(
        F.count("*").alias("n"), *(f(F.col(c).cast("double")).alias(f"{c}_{way}") for c in ["label", *names] for way, f in (("low", F.min), ("high", F.max)))
    ).first()
    low, high = ({c: ends[f"{c}_{way}"] for c in ["label", *names]} for way in ("low", "high"))
    span = high["label"] - low["label"] or 1.0
    rows = train.select(F.xxhash64(*key).alias("key"), F.col("label").cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in names))
    thresholds = grid_thresholds(rows, low, high, names, ends["n"])

    size = 1 << (depth + 1)
    feature, split = np.full((trees, size), -1, np.int16), np.zeros((trees, size), np.int16)
    threshold, value = np.zeros((trees, size)), np.zeros((trees, size))
    plan = {"names": names, "thresholds": thresholds, "seed": seed, "bootstrap": bootstrap, "count": count, "low": low["label"], "span": span}
    mean = lambda total, weight: low["label"] + total / weight / STEPS * span
    # A tree whose sample is empty predicts the middle of the labels.
    value[:, 1] = low["label"] + span / 2
    open_nodes = {tree: np.array([1]) for tree in range(trees)}
    for level in range(depth + 1):
        if not open_nodes or level == depth > 0:
            break
        sums = level_sums(rows, plan | {"feature": feature, "split": split}, open_nodes)
        found = sums.groupBy(F.floor(F.col("tree") / TASK_TREES)).applyInPandas(best_splits, SPLITS).toPandas()
        if level == 0:
            whole = found["weight_left"] + found["weight_right"]
            value[found["tree"], 1] = mean(found["total_left"] + found["total_right"], whole)
        if depth == 0:
            break
        found = found[found["feature"] >= 0]
        tree, node = found["tree"].to_numpy(), found["node"].to_numpy()
        feature[tree, node], split[tree, node] = found["feature"], found["bin"]
        threshold[tree, node] = [thresholds[f][b] for f, b in zip(found["feature"], found["bin"], strict=True)]
        more = []
        for side, child in (("left", 2 * node), ("right", 2 * node + 1)):
            weight = found[f"weight_{side}"].to_numpy()
            value[tree, child] = mean(found[f"total_{side}"].to_numpy(), weight)
            more.append((tree[weight > 1], child[weight > 1]))
        tree, child = (np.concatenate([m[k] for m in more]) for k in (0, 1))
        open_nodes = {int(t): np.sort(child[tree == t]) for t in np.unique(tree)}
    return Forest(names, feature, threshold, value)
