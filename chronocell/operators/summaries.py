"""Per-pixel temporal summaries.

A Summary says which bands it needs, how one observation is prepared (expressions and masks), how the
observations of a day fuse, and how the days reduce. execute() runs any of them as two aggregates over
observation rows; both are partially aggregated before their shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as fold

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronocell.functions.pixels import TASSELLED_CAP, any_bit, bit_field, clip, divided, erase, in_classes, keep, linear, missing, no_bit, sentinel
from chronocell.operators import fuse as fusers
from chronocell.operators.morphology import cleanup_images

PIXEL = ("y", "x")
REGISTRY: dict[str, type[Summary]] = {}


def register(name: str):
    def put(cls):
        if not (isinstance(cls, type) and issubclass(cls, Summary)):
            raise TypeError(f"{cls!r} is not a Summary")
        REGISTRY[name] = cls
        cls.name = name
        return cls

    return put


def import_all() -> list[str]:
    """Imports every module of the operators, so that all their summaries are registered; the names of these."""
    import importlib
    import pkgutil

    from chronocell import operators

    for m in pkgutil.iter_modules(operators.__path__):
        importlib.import_module(f"chronocell.operators.{m.name}")
    return sorted(REGISTRY)


def resolve(name: str) -> type[Summary]:
    """By registered name, else by dotted path."""
    import importlib

    for own in ("geomedian", "landcover"):  # they register theirs
        importlib.import_module(f"chronocell.operators.{own}")
    if name in REGISTRY:
        return REGISTRY[name]
    module, _, attribute = name.rpartition(".")
    if not module:
        raise ValueError(f"no summary {name!r}")

    try:
        cls = getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"no summary {name!r}") from e
    if not (isinstance(cls, type) and issubclass(cls, Summary)):
        raise ValueError(f"{name} is not a Summary")
    return cls


class Summary:
    """bands: needed columns; outputs: result columns; daily: whether days fuse first."""

    name = "summary"
    bands: Sequence[str] = ()
    outputs: Sequence[str] = ()
    daily = True

    def prepare(self, df: DataFrame, image: Sequence[str]) -> DataFrame:
        return df

    def fuse(self) -> list[Column]:
        return [fusers.first_valid(b) for b in self.bands]

    def reduce(self) -> list[Column]:
        raise NotImplementedError

    def finish(self, df: DataFrame) -> DataFrame:
        return df

    def after_fuse(self, df: DataFrame, image: Sequence[str]) -> DataFrame:
        return df


def execute(obs: DataFrame, summary: Summary, pixel: Sequence[str] = PIXEL, day: str = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
    """One row a tile, period and pixel. tile: further key columns (period, tile x, tile y, product)."""
    keys = [*tile, *pixel]
    df = summary.prepare(obs, [*tile, time])
    if summary.daily:
        df = df.groupBy(*keys, day).agg(*summary.fuse())
        df = summary.after_fuse(df, [*tile, day])
    return summary.finish(df.groupBy(*keys).agg(*summary.reduce())).select(*keys, *summary.outputs)


def rank_quantiles(value: str, ps: Sequence[float], least: int = 3) -> list[Column]:
    """Nearest ranks on the sorted valid whole numbers of a column; NULL under least of them. (The interpolation is our choice.)

    Spark's percentile and percentile_disc keep a count for each value and merge before the shuffle, so what a pixel holds is bounded by
    the band's range, not by its observations. One interpolates between two neighbours, the other is one of the two: together
    they give both, and the one at the nearest rank is taken.
    """
    n = f"count(`{value}`)"
    all_between = f"percentile(`{value}`, array({', '.join(f'{p}D' for p in ps)}))"  # one state for all ps

    def nearest(k: int, p: float) -> Column:
        one, between = f"percentile_disc({p}D) WITHIN GROUP (ORDER BY `{value}`)", f"{all_between}[{k}]"
        at, here = f"(({n} - 1) * {p}D)", f"(ceil({n} * {p}D) - 1)"
        part = f"({at} - floor({at}))"
        upper, lower = f"rint({one} + try_divide({between} - {one}, {part}))", f"rint(try_divide({between} - {part} * {one}, 1 - {part}))"
        return F.expr(f"cast(CASE WHEN {n} < {least} THEN NULL WHEN {here} = rint({at}) THEN {one} WHEN {here} = floor({at}) THEN {upper} ELSE {lower} END AS bigint)")

    return [nearest(k, p) for k, p in enumerate(ps)]


@register("wofs-summary")
class WofsSummary(Summary):
    bands = ("water",)
    outputs = ("count_wet", "count_clear", "frequency")
    #: Bits of the classes that filters clean up.
    CLASSES = {"cloud": 64, "cloud_shadow": 32, "terrain_shadow": 8}
    NODATA = -999

    def __init__(self, cloud_filters: dict | None = None):
        self.filters = cloud_filters or {}

    def prepare(self, df, image):
        bad = no_bit("water", 1) & any_bit("water", 255 & ~128)
        if self.filters:
            df = df.withColumns({f"_raw_{k}": any_bit("water", self.CLASSES[k]) for k in self.filters})
            df = cleanup_images(df, {f"_wide_{k}": (f"_raw_{k}", v) for k, v in self.filters.items()}, list(image))
            bad = fold(lambda a, b: a | b, [bad, *[F.col(f"_wide_{k}") for k in self.filters]])
        df = df.withColumn("bad", F.coalesce(bad, F.lit(False)))
        return df.withColumns({"dry": (F.col("water") == 0) & ~F.col("bad"), "wet": (F.col("water") == 128) & ~F.col("bad")})

    def fuse(self):
        return [fusers.any_of(c) for c in ("bad", "dry", "wet")]

    def reduce(self):
        bad, dry, wet = F.col("bad"), F.col("dry"), F.col("wet")
        return [F.count_if(bad).alias("_bad"), F.count_if(wet & ~dry & ~bad).alias("_wet"), F.count_if(dry & ~wet & ~bad).alias("_dry")]

    def finish(self, df):
        clear = F.col("_wet") + F.col("_dry")
        some = F.col("_bad") + clear > 0
        count = lambda c: sentinel(keep(c, some), self.NODATA).cast("short")
        return df.select("*", count(F.col("_wet")).alias("count_wet"), count(clear).alias("count_clear"), divided("_wet", clear).alias("frequency"))


@register("wofs-summary-fh")
class WofsFullHistory(Summary):
    bands = outputs = ("count_wet", "count_clear", "frequency")
    daily = False
    NODATA = -999

    def reduce(self):
        total = lambda c: F.coalesce(F.sum(missing(c, self.NODATA).cast("long")), F.lit(0).cast("long"))
        return [total("count_clear").alias("_cc"), total("count_wet").alias("_cw"), F.count(missing("count_clear", self.NODATA)).alias("_n")]

    def finish(self, df):
        count = lambda c: sentinel(keep(c, F.col("_n") > 0), self.NODATA)
        return df.select("*", count("_cw").alias("count_wet"), count("_cc").alias("count_clear"), divided("_cw", "_cc").alias("frequency"))


@register("pq")
class PixelQuality(Summary):
    """Valid and clear counts from a class band; filters clean the cloud mask after the day's fuse."""

    bands = ("scl",)
    #: Cloud shadows, cloud medium and high probability, thin cirrus.
    CLOUD = (3, 8, 9, 10)
    FILTERS = {"clear_2_5": [("opening", 2), ("dilation", 5)], "clear_0_5": [("opening", 0), ("dilation", 5)]}

    def __init__(self, filters: dict | None = None, nodata: int = 0, cloud: Sequence[int] = CLOUD, band: str = "scl"):
        self.filters = self.FILTERS if filters is None else filters
        self.nodata, self.cloud, self.band = nodata, cloud, band
        self.outputs = ("total", "clear", *self.filters)

    def prepare(self, df, image):
        return df.withColumns({"valid": F.coalesce(F.col(self.band) != self.nodata, F.lit(False)), "erased": F.coalesce(in_classes(self.band, self.cloud), F.lit(False))})

    def fuse(self):
        return [fusers.any_of("valid"), fusers.any_of("erased")]

    def after_fuse(self, df, image):
        return cleanup_images(df, {f"_e_{k}": ("erased", v) for k, v in self.filters.items()}, list(image)) if self.filters else df

    def reduce(self):
        return [F.count_if("valid").alias("total"), F.count_if(F.col("valid") & ~F.col("erased")).alias("clear"), *[F.count_if(F.col("valid") & ~F.col(f"_e_{k}")).alias(k) for k in self.filters]]


@register("pq-ls-bitmask")
class PixelQualityBits(Summary):
    """Counts from a bit-flag band, with optional aerosol level or atmospheric opacity."""

    bands = ("qa",)

    def __init__(self, filters: dict | None = None, aerosol_filters: dict | None = None, mask: int = 0b1100, nodata_mask: int = 1, aerosol: str | None = None, opacity: str | None = None, band: str = "qa"):
        self.filters, self.aerosol_filters = filters or {}, aerosol_filters or {}
        self.mask, self.nodata_mask, self.aerosol, self.opacity, self.band = mask, nodata_mask, aerosol, opacity, band
        dusty = ("clear_aerosol", *self.aerosol_filters) if aerosol or opacity else ()
        self.outputs = ("total", "clear", *self.filters, *dusty)

    def prepare(self, df, image):
        dust = F.lit(False)
        if self.aerosol:
            dust = bit_field(self.aerosol, 6, 2) == 3
        elif self.opacity:
            dust = missing(self.opacity, -9999) * 0.001 > 0.3
        return df.withColumns({"keeps": no_bit(self.band, self.nodata_mask), "erased": any_bit(self.band, self.mask), "dust": F.coalesce(dust, F.lit(False))})

    def fuse(self):
        return [fusers.any_of(c) for c in ("keeps", "erased", "dust")]

    def after_fuse(self, df, image):
        steps = self.filters | self.aerosol_filters
        return cleanup_images(df, {f"_e_{k}": ("erased", v) for k, v in steps.items()}, list(image)) if steps else df

    def reduce(self):
        keeps, erased, dust = F.col("keeps"), F.col("erased"), F.col("dust")
        return [
            F.count_if(keeps).alias("total"),
            F.count_if(keeps & ~erased).alias("clear"),
            F.count_if(keeps & ~dust & ~erased).alias("clear_aerosol"),
            *[F.count_if(keeps & ~F.col(f"_e_{k}")).alias(k) for k in self.filters],
            *[F.count_if(keeps & ~F.col(f"_e_{k}") & ~dust).alias(k) for k in self.aerosol_filters],
        ]


@register("fc-percentiles")
class CoverPercentiles(Summary):
    NODATA = 255
    QUANTILES = (0.1, 0.5, 0.9)

    def __init__(self, bands: Sequence[str] = ("pv", "bs", "npv"), max_sum_limit: float | None = None, clip_range: tuple | None = None, ue_threshold: float | None = None, count_valid: bool = False, cloud_filters: dict | None = None):
        self.bands, self.limit, self.clip, self.ue, self.filters = bands, max_sum_limit, clip_range, ue_threshold, cloud_filters or {}
        self.outputs = (*[f"{b}_pc_{int(q * 100)}" for b in bands for q in self.QUANTILES], "qa", *(["count_valid"] if count_valid else []))

    def prepare(self, df, image):
        valid, wet = no_bit("water", 255 & ~16), F.col("water").bitwiseAND(F.lit(255 & ~16)) == 128
        if self.filters:
            df = df.withColumns({f"_raw_{k}": any_bit("water", WofsSummary.CLASSES[k]) for k in self.filters})
            df = cleanup_images(df, {f"_wide_{k}": (f"_raw_{k}", v) for k, v in self.filters.items()}, list(image))
            clear = ~fold(lambda a, b: a | b, [F.col(f"_wide_{k}") for k in self.filters])
            valid, wet = valid & clear, wet & clear
        if self.ue is not None:
            valid = valid & (F.col("ue") < self.ue)
        if self.limit is not None:
            valid = valid & (fold(lambda a, b: a + b, [F.coalesce(missing(b, self.NODATA), F.lit(0)) for b in self.bands]) < self.limit)
        df = df.withColumns({"valid": F.coalesce(valid, F.lit(False)), "wet": F.coalesce(wet, F.lit(False))})
        value = lambda b: clip(missing(b, self.NODATA), *self.clip) if self.clip else missing(b, self.NODATA)
        return df.withColumns({b: keep(value(b), F.col("valid")) for b in self.bands})

    def fuse(self):
        return [*[fusers.mean_int(b) for b in self.bands], fusers.any_of("wet"), fusers.any_of("valid")]

    def reduce(self):
        pcs = [c.alias(f"{b}_pc_{int(q * 100)}") for b in self.bands for q, c in zip(self.QUANTILES, rank_quantiles(b, self.QUANTILES), strict=True)]
        return [*pcs, F.count_if("valid").alias("count_valid"), F.bool_or(F.col("wet") & ~F.col("valid")).alias("_wet")]

    def finish(self, df):
        names = [f"{b}_pc_{int(q * 100)}" for b in self.bands for q in self.QUANTILES]
        good = fold(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        qa = F.when(good, 2).when(F.col("_wet"), 0).otherwise(1)
        return df.withColumn("qa", qa).withColumns({n: sentinel(n, self.NODATA).cast("short") for n in names})


@register("tcw-percentiles")
class TasselledCapPercentiles(Summary):
    BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
    NODATA, BAND_NODATA = -9999, -999
    QUANTILES = (0.1, 0.5, 0.9)

    def __init__(self, coefficients: dict | None = None, outputs: Sequence[str] = ("wet", "bright", "green"), cloud_filters: dict | None = None, bands: Sequence[str] = BANDS):
        self.bands, self.filters = bands, cloud_filters or {}
        self.coefficients = {k: (coefficients or TASSELLED_CAP)[k] for k in outputs}
        self.outputs = tuple(f"{o}_pc_{int(q * 100)}" for o in outputs for q in self.QUANTILES)

    def prepare(self, df, image):
        bad = (F.col("fmask") == 0) | (F.col("contiguity") == 0) | fold(lambda a, b: a | b, [F.col(b) == self.BAND_NODATA for b in self.bands])
        if self.filters:
            df = df.withColumns({f"_raw_{k}": F.col("fmask") == c for k, (c, _) in self.filters.items()})
            df = cleanup_images(df, {f"_wide_{k}": (f"_raw_{k}", v) for k, (_, v) in self.filters.items()}, list(image))
            bad = fold(lambda a, b: a | b, [bad, *[F.col(f"_wide_{k}") for k in self.filters]])
        else:
            bad = bad | F.col("fmask").isin(2, 3)
        return df.withColumns({f"tc_{o}": erase(linear(self.bands, w).cast("int"), bad) for o, w in self.coefficients.items()})

    def fuse(self):
        return [fusers.mean_int(f"tc_{o}") for o in self.coefficients]

    def reduce(self):
        return [sentinel(c, self.NODATA).cast("int").alias(f"{o}_pc_{int(q * 100)}") for o in self.coefficients for q, c in zip(self.QUANTILES, rank_quantiles(f"tc_{o}", self.QUANTILES), strict=True)]


@register("veg_count")
class VegetationCount(Summary):
    """Longest runs of vegetated and of wet months from monthly medians."""

    bands = ("water", "ue", "pv", "npv", "bs")
    outputs = ("veg_frequency", "water_frequency")
    NODATA = 255

    def __init__(self, ue_threshold: float = 30, cloud_filters: dict | None = None):
        self.ue, self.filters = ue_threshold, cloud_filters or {}

    def run(self, obs: DataFrame, pixel: Sequence[str] = PIXEL, day: str = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
        keys = [*tile, *pixel]
        valid, wet = no_bit("water", 255 & ~28), F.col("water").bitwiseAND(F.lit(255 & ~4)) == 128
        if self.filters:
            obs = obs.withColumns({f"_raw_{k}": any_bit("water", WofsSummary.CLASSES[k]) for k in self.filters})
            obs = cleanup_images(obs, {f"_wide_{k}": (f"_raw_{k}", v) for k, v in self.filters.items()}, [*tile, time])
            clear = ~fold(lambda a, b: a | b, [F.col(f"_wide_{k}") for k in self.filters])
            valid, wet = valid & clear, wet & clear
        obs = obs.withColumns({"_valid": valid, "_wet": wet})
        obs = obs.withColumn("_wetness", F.when(F.col("_wet") | F.col("_valid"), F.col("_wet").cast("double"))).withColumn("_valid", F.col("_valid") & (F.col("ue") < self.ue))
        obs = obs.withColumns({b: keep(missing(b, self.NODATA).cast("double"), F.col("_valid")) for b in ("pv", "npv", "bs")})
        first_wet = fusers.first_valid("_wetness", time)
        daily = obs.groupBy(*keys, day).agg(*[F.avg(b).alias(b) for b in ("pv", "npv", "bs")], first_wet.alias("wet"))
        return self.months(daily.groupBy(*keys, F.month(day).alias("month")).agg(*[F.median(b).alias(b) for b in ("pv", "npv", "bs", "wet")]), keys)

    def months(self, monthly: DataFrame, keys: list[str]) -> DataFrame:
        veg = F.when(F.col("wet") > 0, 0).when(F.col("pv").isNull(), self.NODATA).otherwise(((F.col("pv") > F.col("bs")) | (F.col("npv") > F.col("bs"))).cast("int"))
        water = F.when(F.col("wet").isNull(), self.NODATA).otherwise((F.col("wet") > 0.5).cast("int"))
        m = monthly.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("month", F.coalesce(veg, F.lit(0)).alias("veg"), water.alias("water")))).alias("m"))
        return m.select(*keys, *[run_of(F.col(f"m.{c}"), self.NODATA).alias(f"{c}_frequency") for c in ("veg", "water")])


def run_of(values: Column, nodata: int = 255) -> Column:
    """The longest run of ones of an array in order; missing steps neither extend nor break it; nodata if all are missing."""
    step = lambda a, v: F.when(v == nodata, a).otherwise(F.struct(F.when(v == 0, 0).otherwise(a["run"] + v).alias("run"), F.greatest(a["best"], F.when(v == 0, 0).otherwise(a["run"] + v)).alias("best"), F.lit(True).alias("some")))
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(False).alias("some"))
    return F.aggregate(F.transform(values, lambda v: v.cast("int")), start, step, lambda a: F.when(a["some"], a["best"]).otherwise(nodata))


def longest_run(df: DataFrame, value: str, keys: list[str], nodata: int = 255, order: str = "month") -> DataFrame:
    """keys and run: run_of() of a key's values, of which there are as many as steps (twelve months)."""
    by = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("m"))
    return by.select(*keys, run_of(F.transform("m", lambda s: s["v"]), nodata).alias("run"))


def level1_classes(df: DataFrame, optional: Sequence[str] = ("elevation", "canopy_cover_class"), classes: dict | None = None, dem: float = 6, mudflat: float = 1000, saltpan: float = 1500, water: float = 0.2, veg: int = 2, nodata: int = -999) -> DataFrame:
    """classes_l3_l4 and water_seasonality from frequency, veg_frequency, dem_h, blue, red, green and optional bands."""
    #: Output classes.
    c = {"aquatic_veg": 124, "terrestrial_veg": 110, "water": 221, "intertidal": 223, "surface": 210} | (classes or {})
    f = F.when(~F.isnan("frequency"), F.col("frequency"))
    si5 = F.when(F.col("blue") > nodata, F.col("blue").cast("double") * F.col("red") / F.nullif(F.col("green"), F.lit(0)))
    is_water = F.coalesce(f >= water, F.lit(False))
    bare = F.coalesce((si5 > mudflat) & (F.col("dem_h") <= dem), F.lit(False)) | F.coalesce(si5 > saltpan, F.lit(False)) | (F.col("veg_frequency") < veg)
    cls = F.when(is_water, c["water"]).when(bare, c["surface"])
    base = F.when(is_water, c["water"]).when(bare, c["surface"]).otherwise(0)
    for band in optional:
        if band == "elevation":
            base = F.when(F.col(band).isNotNull() & ~F.isnan(band), F.when(base > 0, c["intertidal"]).otherwise(c["aquatic_veg"])).otherwise(base)
        elif band == "canopy_cover_class":
            base = F.when((F.col(band) > 0) & (F.col(band) < 255), c["aquatic_veg"]).otherwise(base)
    cls = F.when(base <= 0, c["terrestrial_veg"]).otherwise(base)
    cls = F.when(si5.isNull() | (F.col("veg_frequency") >= 255), 255).otherwise(cls)
    season = F.when(f.isNull(), F.lit(255.0)).when((f > 0) & (f <= 0.25), F.lit(1.0)).when((f > 0.25) & (f <= 1), F.lit(2.0)).otherwise(f)
    return df.withColumns({"classes_l3_l4": cls.cast("short"), "water_seasonality": season})


def renamed_inputs(df: DataFrame, names: dict[str, str], nodata: float) -> DataFrame:
    """Bands over the sentinel under their new names."""
    return df.withColumns({b: F.when(F.col(b) > nodata, F.col(b)) for b in names}).withColumnsRenamed(names)


def mangroves(df: DataFrame, thresholds: Sequence[float] = (14, 38, 60), wetness: float = -1850) -> DataFrame:
    """canopy_cover_class from extent (boolean), wet_pc_10, pv_pc_10 and qa."""
    good = F.col("extent") & (F.col("wet_pc_10") > wetness) & (((F.col("pv_pc_10") > thresholds[0]) & (F.col("qa") == 2)) | (F.col("qa") == 1))
    level = fold(lambda a, b: a + b, [(F.col("pv_pc_10") > t).cast("int") for t in thresholds])
    return df.withColumn("canopy_cover_class", F.when(~F.coalesce(good, F.lit(False)), 255).when(F.col("qa") == 1, 0).otherwise(level).cast("short"))


def level3_classes(df: DataFrame) -> DataFrame:
    """level3_class: cultivated where known, else level 1; bare surface takes the urban class."""
    r = F.when(F.col("cultivated_class") < 255, F.col("cultivated_class")).otherwise(F.col("classes_l3_l4"))
    return df.withColumn("level3_class", F.when(r == 210, F.col("urban_classes")).otherwise(r).cast("short"))


def month_medians(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = PIXEL, time: str = "time") -> DataFrame:
    return df.groupBy(*keys, F.month(time).alias("month")).agg(*[F.median(F.when(~F.isnan(F.col(b).cast("double")), F.col(b))).alias(b) for b in bands])
