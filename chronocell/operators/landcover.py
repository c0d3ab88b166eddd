"""Land-cover summaries: classes of one row a pixel, and classes by models with a vote over a pixel's images."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronocell.operators import fuse as fusers
from chronocell.operators import models, spatial, trees
from chronocell.operators.summaries import PIXEL, Summary, level1_classes, level3_classes, mangroves, register, renamed_inputs


class PixelClasses(Summary):
    """No reduction over time: the bands of a pixel's scenes become one row, which is classified."""

    def classify(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def run(self, obs: DataFrame, pixel: Sequence[str] = PIXEL, day: str = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
        keys = [*tile, *pixel]
        obs = obs.withColumn("time", F.col(time))
        one = obs.groupBy(*keys).agg(*[fusers.first_valid(b) for b in self.bands if b in obs.columns])
        return self.classify(one).select(*keys, *self.outputs)


@register("veg_class_l1")
class VegetationClass(PixelClasses):
    outputs = ("classes_l3_l4", "water_seasonality")
    OPTIONAL = ("elevation", "canopy_cover_class")

    def __init__(self, output_classes: dict | None = None, dem_threshold: float = 6, mudflat_threshold: float = 1000, saltpan_threshold: float = 1500, water_threshold: float = 0.2, veg_threshold: int = 2, optional_bands: Sequence[str] = OPTIONAL):
        self.optional, self.classes = tuple(optional_bands), output_classes
        self.bands = ("frequency", "veg_frequency", "dem_h", "blue", "red", "green", *self.optional)
        self.thresholds = {"dem": dem_threshold, "mudflat": mudflat_threshold, "saltpan": saltpan_threshold, "water": water_threshold, "veg": veg_threshold}

    def classify(self, df):
        return level1_classes(df, [b for b in self.optional if b in df.columns], self.classes, **self.thresholds)


@register("dem_in_stats")
class Elevation(PixelClasses):
    def __init__(self, input_bands: Sequence[str] = ("dem_h",), measurements: Sequence[str] | None = None, nodata: float = -9999):
        self.bands, self.outputs, self.nodata = tuple(input_bands), tuple(measurements or input_bands), nodata

    def classify(self, df):
        return renamed_inputs(df, dict(zip(self.bands, self.outputs, strict=True)), self.nodata)


@register("mangroves")
class Mangroves(PixelClasses):
    """mangroves_extent: rings of points, for pixels with centres cx and cy; without it a boolean band `extent`."""

    outputs = ("canopy_cover_class",)

    def __init__(self, mangroves_extent: Sequence | None = None, pv_thresholds: Sequence[float] = (14, 38, 60), tcw_threshold: float = -1850):
        self.rings, self.thresholds, self.wetness = mangroves_extent, tuple(pv_thresholds), tcw_threshold
        self.bands = ("pv_pc_10", "qa", "wet_pc_10", *(("extent",) if mangroves_extent is None else ("cx", "cy")))

    def classify(self, df):
        if self.rings is not None:
            df = spatial.rasterize(df, self.rings)
        elif "extent" not in df.columns:
            raise ValueError("missing mangroves extent")
        return mangroves(df, self.thresholds, self.wetness)


@register("lccs_level3")
class Level3(PixelClasses):
    bands = ("classes_l3_l4", "urban_classes", "cultivated_class")
    outputs = ("level3_class",)

    def classify(self, df):
        return level3_classes(df)


class ModelClass(Summary):
    """load: a function without arguments that returns the model (a function of an array), its dotted path, or the address of
    a tree ensemble's file (.json, .txt), with model_options as trees.loader takes them."""

    vote: Callable
    features: Sequence[str] = ()  # what a model file's trees split on

    def __init__(self, load: Callable | str, output_classes: dict | None = None, input_bands: Sequence[str] | None = None, image: str = "dataset_id", nodata: float = -999, model_options: dict | None = None):
        self.load, self.classes, self.image, self.nodata = load, dict(output_classes or {}), image, nodata
        self.model = self.name
        if isinstance(load, str) and load.endswith((".json", ".txt")):
            self.load = trees.loader(load, self.features, **(model_options or {}))
        elif isinstance(load, str):
            module, _, attribute = load.rpartition(".")
            self.load = getattr(importlib.import_module(module), attribute)
        if input_bands is not None:
            self.bands = tuple(input_bands)

    def images(self, obs: DataFrame, keys: list[str], more: Sequence[str] = ()) -> DataFrame:
        return obs.groupBy(*keys, self.image).agg(*[fusers.first_valid(b) for b in (*self.bands, *more)])

    def voted(self, df: DataFrame, keys: list[str]) -> DataFrame:
        return type(self).vote(df, keys, **self.classes).withColumnRenamed("class", self.outputs[0]).select(*keys, *self.outputs)


class MaskedTree(ModelClass):
    """mask_bands: one band and its code; the mask may come from a scene of its own, it holds for all images of the pixel."""

    bands = (*models.BANDS, "sdev", "edev", "bcdev")

    def __init__(self, load: Callable | str, mask_bands: dict | None = None, **more):
        super().__init__(load, **more)
        (self.mask, self.code), *rest = (mask_bands or {"classes_l3_l4": 110}).items()
        if rest:
            raise ValueError("one mask band")

    def predicted(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def run(self, obs: DataFrame, pixel: Sequence[str] = PIXEL, day: str = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
        keys = [*tile, *pixel]
        obs = obs.withColumn("time", F.col(time))
        if self.mask not in obs.columns:  # nothing is selected, so there is no result
            obs = obs.withColumn(self.mask, F.lit(None).cast("int")).where(F.lit(False))
        df = self.images(obs, keys, [self.mask])
        df = df.withColumn(self.mask, F.max(self.mask).over(Window.partitionBy(*keys)))
        return self.voted(self.predicted(models.masked(df, self.bands, self.mask, int(self.code), self.nodata)), keys)


@register("cultivated_class")
class CultivatedClass(MaskedTree):
    outputs = ("cultivated_class",)
    features = models.FEATURES
    vote = staticmethod(models.cultivated_vote)

    def predicted(self, df):
        whole = df.withColumn("blue", F.when(~F.isnull(sum((F.col(b) for b in models.BANDS[1:]), F.col("blue"))), F.col("blue")))  # a norm needs all bands
        return models.predict(models.tree_features(whole), models.FEATURES, self.load, True, self.model)


@register("woody_cover")
class WoodyCover(MaskedTree):
    outputs = ("woody_cover",)
    features = MaskedTree.bands
    vote = staticmethod(models.woody_vote)

    def predicted(self, df):
        return models.predict(df, self.bands, self.load, False, self.model)


@register("urban_class")
class UrbanClass(ModelClass):
    """Each image's missing pixels are taken from the pixel's other images, in the order of their ids."""

    bands = models.BANDS
    outputs = ("urban_classes",)
    vote = staticmethod(models.urban_vote)

    def __init__(self, load: Callable | str, crop_size: int = 256, **more):
        super().__init__(load, **more)
        self.size = crop_size

    def run(self, obs: DataFrame, pixel: Sequence[str] = PIXEL, day: str = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
        keys = [*tile, *pixel]
        found = models.masked(self.images(obs.withColumn("time", F.col(time)), keys), self.bands, nodata=self.nodata)
        # a pixel's images (as many as the task has scenes) side by side, then a row for each image of the tile
        own = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(self.image, *self.bands))).alias("_own"))
        images = found.select(*tile, self.image).distinct().groupBy(*tile).agg(F.array_sort(F.collect_list(self.image)).alias("_images"))
        every = own.join(images, list(tile)) if tile else own.crossJoin(images)  # without tiles, one row
        every = every.select(*keys, F.explode("_images").alias(self.image), "_own")
        value = lambda b: F.expr(f"coalesce(get(filter(_own, o -> o.`{self.image}` = `{self.image}`), 0).`{b}`, get(filter(_own, o -> o.`{b}` IS NOT NULL), 0).`{b}`)")
        full = every.select(*keys, self.image, *[value(b).alias(b) for b in self.bands])
        return self.voted(models.predict_patches(full, self.bands, self.load, [*tile, self.image], self.size, self.model), keys)
