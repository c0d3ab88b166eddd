"""Queries of model files: tree ensembles written out from a rule, scored by the batch walk and in SQL by nested CASE."""

from __future__ import annotations

import json

from chronocell.catalogue import SQL, query
from chronocell.catalogue_more import IMAGES, imaged, six
from chronocell.operators import models, trees
from chronocell.operators.landcover import WoodyCover


def grown(cuts: dict[str, tuple[float, ...]], n: int, depth: int) -> str:
    """A JSON dump of n full trees: node after node takes the next feature and cut in turn, leaves count in steps of an eighth."""
    names, count = list(cuts), iter(range(1 << 30))

    def node(d: int) -> dict:
        own = {"nodeid": next(ids)}
        k = next(count)
        if d == depth:
            return own | {"leaf": (k * 37 % 41 - 20) / 8}
        name = names[k * 7 % len(names)]
        children = [node(d + 1), node(d + 1)]
        return own | {"split": name, "split_condition": cuts[name][k % len(cuts[name])], "yes": children[0]["nodeid"], "no": children[1]["nodeid"], "missing": children[k % 2]["nodeid"], "children": children}

    out = []
    for _ in range(n):
        ids = iter(range(1 << 30))
        out.append(node(0))
    return json.dumps(out)


CUTS = {"blue": (0.3, 0.55), "green": (0.4, 0.7), "swir1": (0.31, 0.52), "mndwi": (-0.2, 0.13, 0.4), "bui": (-0.3, 0.21), "bsi": (-0.41, 0.17), "tcw": (-0.15, 0.1), "ndmi": (-0.12, 0.33), "baei": (0.6, 1.1), "ndsi": (0.05,)}
CLASSES = trees.from_xgboost(grown(CUTS, 6, 5), models.FEATURES, classes=2)
COVER = trees.from_xgboost(grown({b: (850.0, 1200.5, 2500.0, 4000.0) for b in models.BANDS[:4]}, 5, 6), WoodyCover.features, base=18.0)


@query("m2_tree_ensemble", "f AS (" + SQL["m3_tree_feature_values"] + f") SELECT id, l_linenumber, CASE WHEN {CLASSES.sql()[0]} >= {CLASSES.sql()[1]} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction FROM f")
def tree_ensemble(spark, sf):
    from pyspark.sql import functions as F

    o = six(spark, sf).withColumns({"sdev": F.lit(0.1), "edev": F.lit(50.0), "bcdev": F.lit(0.2)})
    return models.predict(models.tree_features(o), models.FEATURES, lambda: CLASSES, True, "ensemble").select("id", "l_linenumber", "prediction")


@query("a15_woody_model", IMAGES + f", v AS (SELECT y, x, chosen, round(CASE WHEN blue > -999 THEN {COVER.sql()[0]} END, 6) AS p FROM c) SELECT y, x, CASE WHEN NOT any_value(chosen) THEN 255 WHEN bool_or(p <= 20) THEN 114 ELSE 113 END AS woody_cover FROM v GROUP BY ALL")
def woody_model(spark, sf):
    return WoodyCover(lambda: COVER, mask_bands={"classes_l3_l4": 5}).run(imaged(spark, sf), tile=["period"]).select("y", "x", "woody_cover")
