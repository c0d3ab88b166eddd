"""Mask clean-up: opening, closing and dilation by disks, per image (tile and time).

An image is cut to blocks, each with a halo as wide as all steps reach, so that a block's inside comes out as in the whole image,
however large that is. Only set pixels go to Python and come back; the rows themselves meet them in a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isqrt
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

BLOCK = 512  # pixels on a side


def disk(radius: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    """Set wherever a disk around a set cell reaches; outside counts as unset. A disk is a run of cells a row, and a run's sum two lookups."""
    if radius == 0:
        return mask
    h, w = mask.shape
    total = np.zeros((h + 2 * radius, w + 2 * radius + 1), np.int32)
    np.cumsum(np.pad(mask, radius), axis=1, out=total[:, 1:])
    out = np.zeros(mask.shape, bool)
    for i in range(-radius, radius + 1):
        half = isqrt(radius * radius - i * i)
        rows = total[radius + i : radius + i + h]
        out |= rows[:, radius + half + 1 : radius + half + 1 + w] > rows[:, radius - half : radius - half + w]
    return out


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    """The complement of the complement's dilation: outside counts as set."""
    return ~dilate(~mask, radius)


def cleanup(mask: np.ndarray, steps: list[tuple[str, int]]) -> np.ndarray:
    for op, r in steps:
        if op == "dilation":
            mask = dilate(mask, r)
        elif op == "erosion":
            mask = erode(mask, r)
        elif op == "opening":
            mask = dilate(erode(mask, r), r)
        elif op == "closing":
            mask = erode(dilate(mask, r), r)
        else:
            raise ValueError(f"unknown operation {op}")
    return mask


def reach(steps: Sequence[tuple[str, int]]) -> int:
    """How far a pixel's result looks."""
    return sum(r * (2 if op in ("opening", "closing") else 1) for op, r in steps)


def cleanup_images(df: DataFrame, flags: dict[str, tuple[str, list[tuple[str, int]]]], image: list[str], y: str = "y", x: str = "x", block: int = BLOCK) -> DataFrame:
    """New boolean columns from flags: name -> (flag column, steps); a NULL flag is unset, pixels may be absent.

    What lies outside the box of an image's rows is unset to a dilation and set to an erosion. Of rows that share a pixel
    any flag counts for all. A block holds block * block pixels and a halo.
    """
    own = list(dict.fromkeys(flag for flag, _ in flags.values()))
    halo = max(reach(steps) for _, steps in flags.values())
    place = lambda c: F.col(c).cast("long")
    box = df.groupBy(*image).agg(*[f(place(c)).alias(f"_{n}{c}") for c in (y, x) for n, f in (("lo", F.min), ("hi", F.max))])
    rows = df.select(*image, place(y).alias("_y"), place(x).alias("_x"), *[F.coalesce(c, F.lit(False)).alias(f"_f{i}") for i, c in enumerate(own)])
    pixels = rows.where(reduce(or_, [F.col(f"_f{i}") for i in range(len(own))])).groupBy(*image, "_y", "_x").agg(*[F.bool_or(f"_f{i}").alias(f"_f{i}") for i in range(len(own))])
    pixels = _same(pixels, box, image)
    cell = lambda c: F.floor(c / block)
    near = lambda c, name: F.explode(F.sequence(F.greatest(cell(F.col(c) - halo), cell(F.col(f"_lo{name}"))), F.least(cell(F.col(c) + halo), cell(F.col(f"_hi{name}")))))
    dealt = pixels.withColumn("_by", near("_y", y)).withColumn("_bx", near("_x", x))
    schema = StructType([*(df.schema[c] for c in image), StructField("_y", LongType()), StructField("_x", LongType()), *(StructField(f"_r{k}", BooleanType()) for k in range(len(flags)))])

    def run(table: pa.Table) -> pa.Table:
        one = {c: table.column(c)[0].as_py() for c in table.column_names if c.startswith("_")}
        corner, inner = [], []
        for c, name in (("_by", y), ("_bx", x)):
            lo, hi = max(one[c] * block, one[f"_lo{name}"]), min((one[c] + 1) * block - 1, one[f"_hi{name}"])
            inner.append((lo, hi))
            corner.append((max(lo - halo, one[f"_lo{name}"]), min(hi + halo, one[f"_hi{name}"])))
        (y0, y1), (x0, x1) = corner
        i, j = table.column("_y").to_numpy() - y0, table.column("_x").to_numpy() - x0
        part = tuple(slice(lo - c, hi + 1 - c) for (lo, hi), c in zip(inner, (y0, x0), strict=True))
        out = []
        for flag, steps in flags.values():
            on = table.column(f"_f{own.index(flag)}").to_numpy()
            m = np.zeros((y1 - y0 + 1, x1 - x0 + 1), bool)
            inside = on & (i >= 0) & (i < m.shape[0]) & (j >= 0) & (j < m.shape[1])
            m[i[inside], j[inside]] = True
            out.append(cleanup(m, steps)[part])
        at = np.nonzero(np.logical_or.reduce(out))
        keys = {c: pa.array([table.column(c)[0].as_py()] * len(at[0]), table.column(c).type) for c in image}
        return pa.table(keys | {"_y": pa.array(at[0] + inner[0][0], pa.int64()), "_x": pa.array(at[1] + inner[1][0], pa.int64())} | {f"_r{k}": pa.array(o[at]) for k, o in enumerate(out)})

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given by number, as few bytes may be much work
    found = dealt.repartition(tasks, *image, "_by", "_bx").groupBy(*image, "_by", "_bx").applyInArrow(run, schema)
    met = _same(df.withColumns({"_y": place(y), "_x": place(x)}), found, [*image, "_y", "_x"], "left")
    return met.select(*df.columns, *[F.coalesce(f"_r{k}", F.lit(False)).alias(name) for k, name in enumerate(flags)])


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys of which nulls are alike; the left one's stay."""
    other = right.withColumnsRenamed({c: f"_same_{c}" for c in keys})
    return left.join(other, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in keys]), how).drop(*[f"_same_{c}" for c in keys])


def dilate_rows(df: DataFrame, flag: str, radius: int, image: list[str], y: str = "y", x: str = "x") -> DataFrame:
    """The relational form for small radii: set pixels spread over the disk, then meet the image's pixels."""
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in disk(radius)])
    spread = df.where(F.col(flag)).select(*image, y, x, F.explode(offsets).alias("o"))
    hit = spread.select(*image, (F.col(y) + F.col("o.i")).alias(y), (F.col(x) + F.col("o.j")).alias(x)).dropDuplicates().withColumn("dilated", F.lit(True))
    return df.join(hit, [*image, y, x], "left").withColumn("dilated", F.coalesce("dilated", F.lit(False)))
