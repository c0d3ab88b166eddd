"""Model scoring: masking, features, imputation, prediction by a model of the caller's, votes over images."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from chronocell.functions.pixels import norm, spectral_indices

BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
FEATURES = ("blue", "green", "swir1", "swir2", "sdev", "edev", "bcdev", "mndwi", "bui", "bsi", "tcw", "ndmi", "awei_sh", "baei", "ndsi")
NODATA = 255
_MODELS: dict = {}


def worker_model(key: str, pickled: bytes) -> Callable[[np.ndarray], np.ndarray]:
    """The worker's model of a key, loaded once a worker process. Called by the module's name, so that tasks share it."""
    if key not in _MODELS:
        _MODELS[key] = cloudpickle.loads(pickled)()
    return _MODELS[key]


def _sent(load: Callable, name: str) -> tuple[str, bytes]:
    """A model's key (name and content) and its loader."""
    pickled = cloudpickle.dumps(load)
    return f"{name}-{hashlib.sha1(pickled).hexdigest()}", pickled


def masked(df: DataFrame, bands: Sequence[str], mask: str | None = None, code: int | None = None, nodata: float = -999) -> DataFrame:
    """Bands over nodata, and whether the mask band has the code."""
    out = df.withColumns({b: F.when(F.col(b) > nodata, F.col(b).cast("double")) for b in bands})
    return out if mask is None else out.withColumn("selected", F.coalesce(F.col(mask) == code, F.lit(False)))


def tree_features(df: DataFrame) -> DataFrame:
    """The FEATURES of blue .. swir2, sdev, edev and bcdev; indices are of the normalised bands."""
    n = df.withColumn("_n", norm(BANDS)).withColumns({b: F.col(b) / F.col("_n") for b in BANDS})
    return n.withColumns({**spectral_indices(), "edev": F.col("edev") / 1e4}).drop("_n")


def predict(df: DataFrame, features: Sequence[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]], categorical: bool, name: str = "model", nodata: float = NODATA) -> DataFrame:
    """df with `prediction`: load() gives the worker's model once; rows without first feature or mask get nodata."""
    key, pickled = _sent(load, name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from chronocell.operators.models import worker_model

        model = worker_model(key, pickled)
        for b in batches:
            ok = b[features[0]].notna().to_numpy()
            if "selected" in b:
                ok &= b["selected"].to_numpy(bool)
            out = np.full(len(b), float(nodata))
            if ok.any():
                p = np.round(model(b.loc[ok, list(features)].to_numpy(float)), 6)
                out[ok] = p.argmax(1) if categorical else p.reshape(-1)
            yield b.assign(prediction=out)

    return df.mapInPandas(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))


def predict_patches(df: DataFrame, bands: Sequence[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]], image: Sequence[str], size: int = 256, name: str = "patches", nodata: int = NODATA) -> DataFrame:
    """`prediction` 0/1 of image patches of size by size pixels, edge-padded and normalised; nodata without first band."""
    key, pickled = _sent(load, name)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        from chronocell.operators.models import worker_model

        model = worker_model(key, pickled)
        i, j = pdf["y"].to_numpy() - pdf["y"].min(), pdf["x"].to_numpy() - pdf["x"].min()
        block = np.full((i.max() + 1, j.max() + 1, len(bands)), np.nan)
        block[i, j] = pdf[list(bands)].to_numpy(float)
        full = np.nan_to_num(np.pad(block, ((0, size - block.shape[0]), (0, size - block.shape[1]), (0, 0)), "edge"))
        full = full / np.maximum(np.linalg.norm(full, axis=2, keepdims=True), 1e-8)
        p = (model(full)[: block.shape[0], : block.shape[1]] > 0.5).astype(float)
        p[np.isnan(block[..., 0])] = nodata
        pdf["prediction"] = p[i, j]
        return pdf.drop(columns=["_by", "_bx"])

    d = df.withColumns({"_by": F.floor(F.col("y") / size), "_bx": F.floor(F.col("x") / size)})
    return d.groupBy(*image, "_by", "_bx").applyInPandas(run, StructType([*df.schema.fields, StructField("prediction", DoubleType())]))


def imputed(images: Sequence[str], nodata: float = -999) -> dict[str, Column]:
    """For each image's column, its value or the first other image's that has one."""
    value = lambda c: F.when(F.col(c) > nodata, F.col(c))
    return {c: F.coalesce(value(c), *[value(o) for o in images if o != c]) if len(images) > 1 else value(c) for c in images}


def vote(df: DataFrame, value: str, keys: Sequence[str], positive: int, negative: int, nodata: int = NODATA) -> DataFrame:
    """One row a key over images: positive if any vote is 1, negative if any is 0, else nodata."""
    v = F.when(F.col(value) != nodata, F.col(value))
    return df.groupBy(*keys).agg(F.when(F.count(v) == 0, nodata).when(F.max(v) > 0, positive).otherwise(negative).cast("int").alias("class"))


def urban_vote(df: DataFrame, keys: Sequence[str], artificial: int = 215, natural: int = 216) -> DataFrame:
    return vote(df, "prediction", keys, artificial, natural)


def cultivated_vote(df: DataFrame, keys: Sequence[str], cultivated: int = 111, natural: int = 112) -> DataFrame:
    """The models call cultivated 0."""
    flipped = F.when(F.col("prediction") == NODATA, F.lit(NODATA)).otherwise(1 - F.col("prediction"))
    return vote(df.withColumn("prediction", flipped), "prediction", keys, cultivated, natural)


def woody_vote(df: DataFrame, keys: Sequence[str], woody: int = 113, herbaceous: int = 114, threshold: float = 20) -> DataFrame:
    """Herbaceous if any image's cover is at most the threshold."""
    low = F.when(F.col("prediction") <= threshold, 1).when(F.col("prediction") < NODATA, 0).otherwise(NODATA)
    return vote(df.withColumn("prediction", low), "prediction", keys, herbaceous, woody)
