"""Geometric medians with deviations.

No built-in aggregate expresses the fixed point. Pixels of up to HEAVY observations are grouped in blocks of BLOCK by BLOCK
and one Arrow call solves a block, so a call never holds more than BLOCK * BLOCK * HEAVY observations. A pixel with more
is solved by Spark itself: every step adds up the observations' weights and pulls in partial sums, and the deviations' medians
are taken from a sort over all tasks. One-band medians of an even count are the midpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as fold

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from chronocell.functions.pixels import any_bit, no_bit
from chronocell.functions.tables import cut
from chronocell.operators import fuse as fusers
from chronocell.operators.morphology import cleanup_images
from chronocell.operators.summaries import Summary, register


BLOCK, HEAVY = 8, 1 << 14  # pixels on a side; observations of a pixel


def geomedians(x: np.ndarray, valid: np.ndarray, steps: int = 1000, tolerance: float = 1e-6) -> np.ndarray:
    """Of (pixels, observations, bands), by Weiszfeld steps with Vardi and Zhang's rule for all pixels at once; valid says
    which observations count. A pixel leaves the iteration when it stands; without observations it is NaN."""
    n = valid.sum(1)
    m = np.full((len(x), x.shape[2]), np.nan)
    if x.shape[2] == 1:
        some = n > 0
        m[some, 0] = np.nanmedian(np.where(valid, x[..., 0], np.nan)[some], axis=1)
        return m
    x = np.where(valid[..., None], x, 0.0)
    some = np.flatnonzero(n)
    m[some] = x[some].sum(1) / n[some, None]
    moving = some
    for _ in range(steps):
        if not len(moving):
            break
        own, on, now = x[moving], valid[moving], m[moving]
        gap = own - now[:, None]
        d = np.sqrt((gap * gap).sum(2))
        at = (d < 1e-12) & on
        w = np.where(on & ~at, 1 / np.where(on & ~at, d, 1.0), 0.0)
        total = w.sum(1)
        going = total > 0
        t = np.where(going[:, None], (own * w[..., None]).sum(1) / np.where(going, total, 1.0)[:, None], now)
        pull = np.sqrt((((w[..., None] * gap).sum(1)) ** 2).sum(1))
        held = at.sum(1)
        share = np.where(held > 0, np.minimum(1.0, held / np.where(pull > 0, pull, held.clip(1))), 0.0)
        t = (1 - share)[:, None] * t + share[:, None] * now
        m[moving] = t
        moved = np.sqrt(((t - now) ** 2).sum(1))
        moving = moving[moved > tolerance * np.maximum(1.0, np.sqrt((t * t).sum(1)))]
    return m


def geomedian(x: np.ndarray, steps: int = 1000, tolerance: float = 1e-6) -> np.ndarray:
    """Of (observations, bands) without missing values."""
    return geomedians(x[None], np.ones((1, len(x)), bool), steps, tolerance)[0]


def deviations(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Median cosine, Euclidean and Bray-Curtis distances of each pixel's observations to its median."""
    x = np.where(valid[..., None], x, 0.0)
    gap = x - m[:, None]
    e = np.sqrt((gap * gap).sum(2))
    size = np.sqrt((x * x).sum(2)) * np.sqrt((m * m).sum(1))[:, None]
    c = 1 - np.einsum("pob,pb->po", x, m) / np.maximum(size, 1e-300)
    b = np.abs(gap).sum(2) / np.maximum(np.abs(x + m[:, None]).sum(2), 1e-300)
    out = np.full((len(x), 3), np.nan)
    some = valid.any(1)
    for i, d in enumerate((c, e, b)):
        out[some, i] = np.nanmedian(np.where(valid, d, np.nan)[some], axis=1)
    return out


def geomedian_rows(days: DataFrame, bands: Sequence[str], keys: Sequence[str], aux: Sequence[str] = ("smad", "emad", "bcmad", "count"), block: int = BLOCK, heavy: int = HEAVY, at_once: int = 1 << 22, steps: int = 1000, tolerance: float = 1e-6) -> DataFrame:
    """One row a key: the bands' geomedian, the deviations and the count of observations with all bands.

    Which pixels are heavy is found by a count that runs at once.
    """
    days = days.select(*keys, *bands)
    whole = days.dropna(subset=list(bands)) if len(bands) > 1 else days.where(F.col(bands[0]).isNotNull())
    many = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy).select(*keys)
    many = cut(many)
    if many.isEmpty():
        return _light(days, bands, keys, aux, block, at_once, steps, tolerance)
    own = whole.join(many, [*keys], "left_semi")
    light = _light(days.join(many, [*keys], "left_anti"), bands, keys, aux, block, at_once, steps, tolerance)
    return light.unionByName(heavy_rows(cut(own), bands, keys, aux, steps, tolerance))


def _light(days: DataFrame, bands: Sequence[str], keys: Sequence[str], aux: Sequence[str], block: int, at_once: int, steps: int, tolerance: float) -> DataFrame:
    schema = StructType([*(days.schema[k] for k in keys), *(StructField(c, DoubleType()) for c in (*bands, *aux[:3])), StructField(aux[3], IntegerType())])

    def solve(table: pa.Table) -> pa.Table:
        place = np.stack([table.column(k).to_numpy() for k in keys[-2:]], 1)  # y, x: a block holds one tile
        pixel, first, of = np.unique(place, axis=0, return_index=True, return_inverse=True)
        values = np.stack([table.column(b).to_numpy().astype(float) for b in bands], 1)
        by = np.argsort(of.ravel(), kind="stable")
        of, values = of.ravel()[by], values[by]
        count = np.bincount(of, minlength=len(pixel))
        nth = np.arange(len(of)) - np.repeat(count.cumsum() - count, count)
        m, dev, n = np.full((len(pixel), len(bands)), np.nan), np.full((len(pixel), 3), np.nan), np.zeros(len(pixel), np.int32)
        lo = 0
        while lo < len(pixel):  # as many pixels as fit, padded to the longest
            hi = lo + 1
            while hi < len(pixel) and (hi + 1 - lo) * count[lo : hi + 1].max() * len(bands) <= at_once:
                hi += 1
            on = slice(int(count[:lo].sum()), int(count[:hi].sum()))
            x = np.full((hi - lo, int(count[lo:hi].max()), len(bands)), np.nan)
            x[of[on] - lo, nth[on]] = values[on]
            valid = ~np.isnan(x).any(2)
            m[lo:hi] = geomedians(x, valid, steps, tolerance)
            dev[lo:hi], n[lo:hi] = deviations(x, valid, m[lo:hi]), valid.sum(1)
            lo = hi
        out = {k: table.column(k).take(pa.array(first)) for k in keys}
        out |= {b: pa.array(m[:, i]) for i, b in enumerate(bands)} | {a: pa.array(dev[:, i]) for i, a in enumerate(aux[:3])} | {aux[3]: pa.array(n)}
        return pa.table(out)

    # blocks of block by block pixels of one tile: a fixed size, whatever the input
    *tile, y, x = keys
    part = days.withColumns({"_by": F.floor(F.col(y) / block), "_bx": F.floor(F.col(x) / block)})
    tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given by number, as few bytes may be much work
    return part.repartition(tasks, *tile, "_by", "_bx").groupBy(*tile, "_by", "_bx").applyInArrow(solve, schema)


def heavy_rows(obs: DataFrame, bands: Sequence[str], keys: Sequence[str], aux: Sequence[str], steps: int = 1000, tolerance: float = 1e-6) -> DataFrame:
    """geomedian_rows of pixels whose observations (none missing) are too many for one task. A step joins the observations to their
    pixel's median so far and adds up by pixel, partially before the shuffle; pixels that stand leave the iteration."""
    value = [F.col(b).cast("double") for b in bands]
    total = lambda exprs: F.sqrt(fold(lambda a, b: a + b, [e * e for e in exprs]))
    if len(bands) == 1:
        sized = obs.withColumn(bands[0], value[0])
        medians = distributed_medians(sized, keys, bands).select(*keys, F.col(bands[0]).alias("_m0"))
    else:
        now = cut(obs.groupBy(*keys).agg(*[F.avg(v).alias(f"_m{i}") for i, v in enumerate(value)]).withColumn("_moves", F.lit(True)))
        m = [F.col(f"_m{i}") for i in range(len(bands))]
        t = [F.col(f"_t{i}") for i in range(len(bands))]
        for _ in range(steps):
            moving = now.where("_moves")
            if moving.isEmpty():
                break
            d = total([v - c for v, c in zip(value, m, strict=True)])
            w = F.when(d < 1e-12, 0.0).otherwise(1 / d)
            near = obs.join(moving.drop("_moves"), [*keys]).withColumn("_w", w)
            sums = near.groupBy(*keys, *m).agg(F.sum("_w").alias("_s"), F.count_if(F.col("_w") == 0).alias("_held"), *[F.sum(F.col("_w") * v).alias(f"_t{i}") for i, v in enumerate(value)], *[F.sum(F.col("_w") * (v - c)).alias(f"_p{i}") for i, (v, c) in enumerate(zip(value, m, strict=True))])
            pull, free = total([F.col(f"_p{i}") for i in range(len(bands))]), F.col("_s") > 0
            share = F.when(F.col("_held") > 0, F.least(F.lit(1.0), F.when(pull > 0, F.col("_held") / pull).otherwise(1.0))).otherwise(0.0)
            sums = sums.withColumns({f"_t{i}": F.when(free, c / F.col("_s")).otherwise(m[i]) for i, c in enumerate(t)} | {"_share": share})
            sums = sums.withColumns({f"_t{i}": (1 - F.col("_share")) * c + F.col("_share") * m[i] for i, c in enumerate(t)})
            moved = total([c - p for c, p in zip(t, m, strict=True)]) > tolerance * F.greatest(F.lit(1.0), total(t))
            step = sums.select(*keys, *[c.alias(f"_m{i}") for i, c in enumerate(t)], moved.alias("_moves"))
            now = cut(now.where("NOT _moves").unionByName(step))
        medians = now.drop("_moves")
    m = [F.col(f"_m{i}") for i in range(len(bands))]
    near = obs.join(medians, [*keys])
    gap = [v - c for v, c in zip(value, m, strict=True)]
    plus = lambda exprs: fold(lambda a, b: a + b, exprs)
    cosine = 1 - plus([v * c for v, c in zip(value, m, strict=True)]) / F.greatest(total(value) * total(m), F.lit(1e-300))
    curtis = plus([F.abs(g) for g in gap]) / F.greatest(plus([F.abs(v + c) for v, c in zip(value, m, strict=True)]), F.lit(1e-300))
    near = near.select(*keys, cosine.alias(aux[0]), total(gap).alias(aux[1]), curtis.alias(aux[2]))
    out = distributed_medians(near, keys, aux[:3], aux[3]).join(medians, [*keys])
    return out.select(*keys, *[c.alias(b) for c, b in zip(m, bands, strict=True)], *aux)


def distributed_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], count: str = "_count") -> DataFrame:
    """keys, the exact median of each column's values and their number, though a key's rows may fill many tasks: rows are sorted over all
    tasks by key and value, each task numbers its runs, and the tasks' counts say where each run begins."""
    long = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])))
    key = [*keys, "_c"]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(long.repartitionByRange(tasks, *key, "_v").sortWithinPartitions(*key, "_v").withColumn("_p", F.spark_partition_id()))
    counts = placed.groupBy(*key, "_p").agg(F.count(F.lit(1)).alias("_n"))
    of = Window.partitionBy(*key)
    start = F.coalesce(F.sum("_n").over(of.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = cut(counts.select(*key, "_p", start.alias("_start"), F.sum("_n").over(of).alias(count), "_n"))  # a row a key and task
    middle = counts.withColumn("_want", F.array_distinct(F.array(F.floor((F.col(count) - 1) / 2), F.floor(F.col(count) / 2))))
    wanted = middle.select(*key, "_p", count, F.explode("_want").alias("_rank"), "_start", "_n").where("_rank >= _start AND _rank < _start + _n")
    wanted = wanted.select(*key, "_p", count, (F.col("_rank") - F.col("_start")).alias("_nth"))
    schema = StructType([*placed.schema.fields, StructField("_nth", LongType())])

    def number(batches):
        last, n = None, 0
        for b in batches:
            cols = [b.column(c) for c in key]
            own = list(zip(*(c.to_pylist() for c in cols), strict=True))
            nth = np.empty(len(own), np.int64)
            for i, k in enumerate(own):
                n = n + 1 if k == last else 0
                last, nth[i] = k, n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nth)], names=[*b.schema.names, "_nth"])

    found = placed.mapInArrow(number, schema).join(wanted, [*key, "_p", "_nth"])
    by = found.groupBy(*keys).agg(*[F.avg(F.when(F.col("_c") == i, F.col("_v"))).alias(c) for i, c in enumerate(columns)], F.max(count).cast("int").alias(count))
    return by.select(*keys, *columns, count)


@register("gm-generic")
class Geomedian(Summary):
    """Class-mask geomedian. mask classes: nodata and cloud numbers; filters: class number -> clean-up steps."""

    aux = ("smad", "emad", "bcmad", "count")

    def __init__(self, bands: Sequence[str] = ("blue", "green", "red", "nir"), mask_band: str = "fmask", nodata: Sequence[int] | None = (0,), cloud: Sequence[int] = (2, 3), cloud_filters: dict | None = None, contiguity: str | None = None, tolerance: float = 1e-6, heavy: int = HEAVY):
        self.bands, self.mask, self.nodata, self.cloud, self.filters, self.contiguity = tuple(bands), mask_band, nodata, cloud, cloud_filters or {}, contiguity
        self.solver = {"tolerance": tolerance, "heavy": heavy}
        self.outputs = (*self.bands, *self.aux)

    def prepare(self, df, image):
        if self.nodata is None:
            return df
        bad = F.col(self.mask).isin(list(self.nodata))
        if self.contiguity:
            bad = bad | (F.col(self.contiguity) == 0)
        if self.filters:
            df = df.withColumns({f"_raw_{k}": F.col(self.mask) == k for k in self.filters})
            df = cleanup_images(df, {f"_wide_{k}": (f"_raw_{k}", v) for k, v in self.filters.items()}, list(image))
            for k in self.filters:
                bad = bad | F.col(f"_wide_{k}")
        else:
            bad = bad | F.col(self.mask).isin(list(self.cloud))
        return df.withColumns({b: F.when(~F.coalesce(bad, F.lit(False)), F.col(b)) for b in self.bands})

    def run(self, obs: DataFrame, pixel: Sequence[str] = ("y", "x"), day: str | None = "solar_day", time: str = "time", tile: Sequence[str] = ()) -> DataFrame:
        keys = [*tile, *pixel]
        df = self.prepare(obs, [*tile, time])
        if day:
            df = df.groupBy(*keys, day).agg(*self.fuse())
        return geomedian_rows(df, self.bands, keys, self.aux, **self.solver)


@register("gm-s2")
class GeomedianS2(Geomedian):
    aux = ("SMAD", "EMAD", "BCMAD", "COUNT")
    #: Classes 3, 8, 9, 10 with opening 2, dilation 5.
    FILTERS = {c: [("opening", 2), ("dilation", 5)] for c in (3, 8, 9, 10)}

    def __init__(self, bands: Sequence[str] = ("blue", "green", "red", "nir"), cloud_filters: dict | None = None, **more):
        super().__init__(bands, "scl", (0, 1), (3, 8, 9, 10), self.FILTERS if cloud_filters is None else cloud_filters, **more)


@register("gm-ls")
class GeomedianLandsat(Geomedian):
    aux = ("sdev", "edev", "bcdev", "count")


@register("gm-ls-bitmask")
class GeomedianBits(Geomedian):
    """Bit-mask geomedian, rescaled and rounded half to even; missing is 0."""

    def __init__(self, bands: Sequence[str] = ("red",), qa: str = "qa", cloud_mask: int = 0b1100, nodata_mask: int = 1, filters: list | None = None, offset: float = -0.2, scale: float = 0.0000275, output_scale: float = 10000, **more):
        super().__init__(bands, **more)
        self.qa, self.cloud_mask, self.nodata_mask, self.steps = qa, cloud_mask, nodata_mask, filters
        self.offset, self.scale, self.output_scale = offset, scale, output_scale

    def prepare(self, df, image):
        good = no_bit(self.qa, self.nodata_mask)
        for b in self.bands:
            good = good & (F.col(b) > -self.offset / self.scale)
        return df.withColumns({**{b: F.when(good, F.col(b)) for b in self.bands}, "cloud_mask": any_bit(self.qa, self.cloud_mask)})

    def fuse(self):
        return [*[fusers.first_valid(b) for b in self.bands], fusers.any_of("cloud_mask")]

    def run(self, obs, pixel=("y", "x"), day="solar_day", time="time", tile=()):
        keys = [*tile, *pixel]
        df = self.prepare(obs, [*tile, time]).groupBy(*keys, day).agg(*self.fuse())
        mask = "cloud_mask"
        if self.steps:
            df, mask = cleanup_images(df, {"_wide": ("cloud_mask", self.steps)}, [*tile, day]), "_wide"
        df = df.withColumns({b: F.when(~F.col(mask), F.col(b)) for b in self.bands})
        out = geomedian_rows(df, self.bands, keys, self.aux, **self.solver)
        level = lambda c, off: F.when(~F.isnan(c), F.rint(F.col(c) * (self.scale * self.output_scale) + off).cast("int")).otherwise(F.lit(0))
        return out.withColumns({**{b: level(b, self.offset * self.output_scale) for b in self.bands}, "emad": level("emad", 0.0)})
