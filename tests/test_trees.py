"""Tree ensembles: files of both formats against node-by-node walks and against nested CASE."""

import json
import math

import duckdb
import numpy as np
import pytest

from chronocell.catalogue_models import COVER, grown
from chronocell.operators import trees
from chronocell.operators.landcover import WoodyCover
from chronocell.operators.models import worker_model  # noqa: F401  the workers' cache

LIGHT = """tree
version=v4
num_class=1
num_tree_per_iteration=1
feature_names=b Column_0
feature_infos=[0:9] [0:9]

Tree=0
num_leaves=3
num_cat=0
split_feature=0 1
threshold=2.5 -1.0
decision_type=2 8
left_child=1 -1
right_child=-2 -3
leaf_value=1.5 -4 0.25
shrinkage=1

Tree=1
num_leaves=1
leaf_value=10

Tree=2
num_leaves=2
num_cat=0
split_feature=1
threshold=0
decision_type=6
left_child=-1
right_child=-2
leaf_value=100 200

end of trees
"""


def walk(node, row):
    """One row down one tree of a dump."""
    while "leaf" not in node:
        v = row[node["split"]]
        go = node["missing"] if math.isnan(v) else node["yes"] if np.float32(v) < np.float32(node["split_condition"]) else node["no"]
        node = next(c for c in node["children"] if c["nodeid"] == go)
    return node["leaf"]


def test_batches_equal_rows_and_case():
    text = grown({"a": (0.1, 0.7), "b": (-2.0, 0.0, 3.5), "c": (0.3,)}, 7, 4)
    model = trees.from_xgboost(text, ("a", "b", "c", "unused"), classes=3, base=0.5)
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(500, 4)), 1)
    x[r.random(x.shape) < 0.1] = np.nan
    x[0] = np.float32(0.1)  # equal to a cut in single precision
    want = np.full((500, 3), 0.5)
    for i, row in enumerate(x):
        for k, t in enumerate(json.loads(text)):
            want[i, k % 3] += walk(t, dict(zip("abc", row, strict=False)))
    assert np.allclose(model(x), want, atol=1e-12)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (n INT, a DOUBLE, b DOUBLE, c DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", [(i, *(None if math.isnan(v) else float(v) for v in row[:3])) for i, row in enumerate(x)])
    assert np.allclose(con.execute(f"SELECT {', '.join(model.sql())} FROM t ORDER BY n").fetchall(), want, atol=1e-12)
    assert trees.from_xgboost(text, ("a", "b", "c"), mean=True)(x[:, :3]) == pytest.approx((want - 0.5).sum(1) / 7)


def test_text_models():
    model = trees.from_lightgbm(LIGHT, ("a", "b"))  # the file's first feature is b, its second column 0
    x = np.array([[-1.0, 2.5], [-0.5, 2.5], [0.0, 9.0], [np.nan, 2.5], [5.0, np.nan], [1e-36, 3.0]])
    # tree 0: b <= 2.5 (missing counts as 0) then a <= -1 (missing goes right); tree 2: a <= 0, missing and zero go left
    assert model(x).tolist() == [1.5 + 10 + 100, 0.25 + 10 + 100, -4 + 10 + 100, 0.25 + 10 + 100, 0.25 + 10 + 200, -4 + 10 + 100]
    assert len(model.sql()) == 1 and "<=" in model.sql()[0]
    with pytest.raises(ValueError, match="no features"):
        trees.from_lightgbm(LIGHT, ("a",))
    with pytest.raises(ValueError, match="category"):
        trees.from_lightgbm(LIGHT.replace("decision_type=2 8", "decision_type=1 8"), ("a", "b"))
    with pytest.raises(ValueError, match="no feature"):
        trees.from_xgboost(grown({"z": (1.0,)}, 1, 1), ("a",))


def test_a_summary_reads_its_model_file(spark, tmp_path):
    path = tmp_path / "woody.json"
    path.write_text(grown({b: (850.0, 1200.5, 2500.0, 4000.0) for b in ("blue", "green", "red", "nir")}, 5, 6))
    summary = WoodyCover(f"file://{path}", model_options={"base": 18.0})
    model, x = summary.load(), np.random.default_rng(1).uniform(500, 5000, (50, 9))
    assert np.allclose(model(x), COVER(x)) and model.features == WoodyCover.features
