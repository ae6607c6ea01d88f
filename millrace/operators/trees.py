"""What each feature adds to the score of a tree ensemble, row by row, as column expressions.

Walking a tree from its root, every step changes the expected score from that of a node to that of its child; the step
is put down to the feature on which the node splits. Over all trees these steps and the roots' scores add up to the raw
prediction. A row's leaf in a tree tells all its steps there, so a row is led to its leaves once, by comparisons that
Spark compiles, and what each feature adds is looked up by leaf."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Nodes:
    """All nodes by number: children (-1 for leaves), feature, threshold and weighted score; the roots; the greatest depth."""

    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    score: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    depth: int = 0

    def put(self, node, weight: float, depth: int = 0) -> int:
        at = len(self.left)
        self.depth = max(self.depth, depth)
        for values, v in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0), (self.score, weight * node.prediction())):
            values.append(v)
        if node.subtreeDepth() > 0:
            split = node.split()
            if not hasattr(split, "threshold") or "Continuous" not in split.getClass().getSimpleName():
                raise ValueError("splits by category aren't supported; encode categories as indicators")
            self.feature[at], self.threshold[at] = split.featureIndex(), split.threshold()
            self.left[at], self.right[at] = (self.put(child, weight, depth + 1) for child in (node.leftChild(), node.rightChild()))
        return at


def nodes_of(model) -> Nodes:
    """The nodes of a fitted tree ensemble. Of boosted trees the scores add up to the margin; its double is the logit of the probability."""
    out = Nodes()
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        out.roots.append(out.put(tree._call_java("rootNode"), float(weight)))
    return out


def bias(nodes: Nodes) -> float:
    """The score before any feature is looked at."""
    return sum(nodes.score[r] for r in nodes.roots)


def paths(nodes: Nodes, root: int) -> list[list[tuple[int, float]]]:
    """Of each leaf of a tree, from left to right: the steps on the way to it, as feature and delta."""
    if nodes.left[root] < 0:
        return [[]]
    return [[(nodes.feature[root], nodes.score[to] - nodes.score[root]), *rest] for to in (nodes.left[root], nodes.right[root]) for rest in paths(nodes, to)]


def leaf(nodes: Nodes, values: Column, root: int, first: int = 1) -> Column:
    """The leaf of a tree that a row falls in, counted from `first` on; values is an array of its features."""

    def walk(node: int, at: int) -> tuple[Column, int]:
        if nodes.left[node] < 0:
            return F.lit(at), at + 1
        left, at = walk(nodes.left[node], at)
        right, at = walk(nodes.right[node], at)
        return F.when(F.element_at(values, nodes.feature[node] + 1) <= nodes.threshold[node], left).otherwise(right), at

    return walk(root, first)[0]


def contributions(nodes: Nodes, values: Column, names: Sequence[str]) -> Column:
    """array<struct<contribution, feature>>, an entry for each feature in order; with `bias` they add up to the raw prediction.

    What a row's steps add is known by its leaf: an array of literals for each tree, depth and feature split on there."""
    sums = [F.lit(0.0)] * len(names)
    for root in nodes.roots:
        ways = paths(nodes, root)
        here = leaf(nodes, values, root)
        for depth in range(max(map(len, ways))):
            for i in sorted({way[depth][0] for way in ways if depth < len(way)}):
                deltas = [way[depth][1] if depth < len(way) and way[depth][0] == i else 0.0 for way in ways]
                sums[i] = sums[i] + F.element_at(F.lit(deltas), here)
    return F.array(*(F.struct(s.alias("contribution"), F.lit(n).alias("feature")) for s, n in zip(sums, names, strict=True)))


def greatest(parts: Column, most: int = 3) -> Column:
    """The features that raise the score most, as JSON, the greatest first; equal ones by name."""
    order = lambda a, b: F.when((a["contribution"] > b["contribution"]) | ((a["contribution"] == b["contribution"]) & (a["feature"] < b["feature"])), -1).otherwise(1)
    return F.to_json(F.slice(F.array_sort(F.filter(parts, lambda x: x["contribution"] > 0), order), 1, most))
