"""Tree ensembles from model files, walked for a whole batch of rows at once, or as SQL.

Two public text formats are read: the JSON dump of XGBoost (a list of nested nodes; yes where a feature, as a single-precision
number, is under split_condition) and the text model of LightGBM (left where a feature is at most the threshold). Missing values take
the branch the file names. Trees belong to classes in turn; sums of leaves are the scores, or their means for forests.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession

#: Bits of LightGBM's decision_type.
CATEGORICAL, DEFAULT_LEFT, MISSING_ZERO, MISSING_NAN = 1, 2, 4, 8
ZERO = 1e-35  # and what LightGBM takes for zero


@dataclass(frozen=True)
class Tree:
    """Node arrays; feature is -1 at leaves. zero: whether missing values and zeros are alike."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    missing_left: np.ndarray
    zero: np.ndarray
    value: np.ndarray


@dataclass(frozen=True)
class Ensemble:
    trees: tuple[Tree, ...]
    features: tuple[str, ...]
    classes: int = 1
    base: float = 0.0
    mean: bool = False
    at_most: bool = False  # left is <= and not <
    single: bool = True  # features are compared as single-precision numbers

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(rows,) of one class, else (rows, classes), of rows of features."""
        x = x.astype(np.float32) if self.single else x
        out = np.zeros((len(x), self.classes))
        rows = np.arange(len(x))
        for k, t in enumerate(self.trees):
            at = np.zeros(len(x), np.int64)
            going = rows
            while len(going := going[t.feature[at[going]] >= 0]):
                node = at[going]
                v, cut = x[going, t.feature[node]], t.threshold[node]
                gone = np.isnan(v) | (t.zero[node] & (np.abs(v) <= ZERO))
                left = np.where(gone, t.missing_left[node], (v <= cut) if self.at_most else (v < cut))
                at[going] = np.where(left, t.left[node], t.right[node])
            out[:, k % self.classes] += t.value[at]
        if self.mean:
            out /= max(1, len(self.trees) // self.classes)
        out += self.base
        return out[:, 0] if self.classes == 1 else out

    def sql(self, kind: str = "DOUBLE") -> list[str]:
        """The score of each class as nested CASE of the features' columns."""

        def branch(t: Tree, i: int) -> str:
            if t.feature[i] < 0:
                return f"{float(t.value[i]):.17e}"
            name = self.features[t.feature[i]]
            v, cut = (f"CAST({c} AS FLOAT)" for c in (name, f"{float(t.threshold[i]):.17e}")) if self.single else (name, f"{float(t.threshold[i]):.17e}")
            gone = f"{name} IS NULL" + (f" OR abs({name}) <= 1e-35" if t.zero[i] else "")
            left, right = branch(t, t.left[i]), branch(t, t.right[i])
            return f"CASE WHEN {gone} THEN {left if t.missing_left[i] else right} WHEN {v} {'<=' if self.at_most else '<'} {cut} THEN {left} ELSE {right} END"

        share = max(1, len(self.trees) // self.classes) if self.mean else 1
        sums = [" + ".join(f"({branch(t, 0)})" for t in self.trees[c :: self.classes]) or "0e0" for c in range(self.classes)]
        return [f"CAST(({s}) / {share} + {self.base:.17e} AS {kind})" for s in sums]


def _tree(nodes: dict[int, tuple]) -> Tree:
    """nodes: number -> (feature, threshold, left, right, missing_left, zero, value), 0 the root."""
    place = {n: i for i, n in enumerate(sorted(nodes))}
    rows = [nodes[n] for n in sorted(nodes)]
    child = lambda k: np.array([place.get(r[k], 0) for r in rows], np.int64)
    return Tree(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float), child(2), child(3), np.array([r[4] for r in rows], bool), np.array([r[5] for r in rows], bool), np.array([r[6] for r in rows], float))


def from_xgboost(text: str, features: Sequence[str], classes: int = 1, base: float = 0.0, mean: bool = False) -> Ensemble:
    """Of a JSON dump; splits name a feature, or its number as f0, f1, ..."""
    number = {f: i for i, f in enumerate(features)} | {f"f{i}": i for i in range(len(features))}

    def nodes(node: dict, out: dict) -> dict:
        if "leaf" in node:
            out[node["nodeid"]] = (-1, 0.0, None, None, False, False, node["leaf"])
        else:
            if node["split"] not in number:
                raise ValueError(f"the model splits on {node['split']!r}, which is no feature")
            out[node["nodeid"]] = (number[node["split"]], np.float32(node["split_condition"]), node["yes"], node["no"], node.get("missing", node["yes"]) == node["yes"], False, 0.0)
            for c in node["children"]:
                nodes(c, out)
        return out

    return Ensemble(tuple(_tree(nodes(t, {})) for t in json.loads(text)), tuple(features), classes, base, mean)


def from_lightgbm(text: str, features: Sequence[str]) -> Ensemble:
    """Of a text model; its feature_names are found among features by name, Column_k by number."""
    head, *parts = text.split("\nTree=")
    fields = lambda part: dict(line.split("=", 1) for line in part.splitlines() if "=" in line)
    top = fields(head)
    names = top["feature_names"].split()
    order = {f: i for i, f in enumerate(features)}
    if unknown := [n for n in names if n not in order and not n.startswith("Column_")]:
        raise ValueError(f"the model splits on {unknown}, which are no features")
    number = [order[n] if n in order else int(n.removeprefix("Column_")) for n in names]
    trees = []
    for part in parts:
        f = fields(part.split("\nend of trees")[0])
        ints, floats = (lambda k, f=f: [int(v) for v in f.get(k, "").split()]), (lambda k, f=f: [float(v) for v in f.get(k, "").split()])
        kinds = ints("decision_type")
        if any(k & CATEGORICAL for k in kinds):
            raise ValueError("splits by category are not read")
        inner = len(kinds)
        leaf = lambda c, inner=inner: c if c >= 0 else inner + ~c  # noqa: E731  leaves are numbered by complements
        nodes = {}
        for i, (k, feature, cut, a, b) in enumerate(zip(kinds, ints("split_feature"), floats("threshold"), ints("left_child"), ints("right_child"), strict=True)):
            none = not k & (MISSING_ZERO | MISSING_NAN)  # then a missing value counts as 0
            nodes[i] = (number[feature], cut, leaf(a), leaf(b), 0.0 <= cut if none else bool(k & DEFAULT_LEFT), bool(k & MISSING_ZERO), 0.0)
        for i, v in enumerate(floats("leaf_value")):
            nodes[inner + i] = (-1, 0.0, None, None, False, False, v)
        trees.append(_tree(nodes))
    return Ensemble(tuple(trees), tuple(features), int(top.get("num_tree_per_iteration", 1)), mean="average_output" in head.split(), at_most=True, single=False)


def loader(path: str, features: Sequence[str], **options) -> Callable[[], Ensemble]:
    """For models.predict(): a file that Spark can read; its arrays go to the workers, once each."""
    text = SparkSession.active().read.text(path, wholetext=True).first()[0]
    model = from_xgboost(text, features, **options) if text.lstrip().startswith("[") else from_lightgbm(text, features)
    return lambda: model
