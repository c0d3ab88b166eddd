"""Scalar expressions on observation columns. Missing is NULL inside the engine; sentinels live at the edges."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce as fold

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tasselled-cap coefficients of blue, green, red, nir, swir1, swir2 (Crist 1985).
TASSELLED_CAP = {
    "wet": (0.0315, 0.2021, 0.3102, 0.1594, -0.6806, -0.6109),
    "bright": (0.2043, 0.4158, 0.5524, 0.5741, 0.3124, 0.2303),
    "green": (-0.1603, -0.2819, -0.4934, 0.7940, -0.0002, -0.1446),
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(band: Column | str, nodata) -> Column:
    """Sentinel (or NaN) to NULL."""
    band = as_column(band)
    if nodata is None or nodata != nodata:
        return F.when(~F.isnan(band), band)
    return F.nullif(band, F.lit(nodata))


def sentinel(value: Column | str, nodata) -> Column:
    return F.coalesce(as_column(value), F.lit(nodata))


def above(band: Column | str, nodata) -> Column:
    """Values over the sentinel; NULL otherwise."""
    band = as_column(band)
    return F.when(band > nodata, band)


def flag_mask(definition: dict, **flags) -> int:
    """Bits of a flag definition that the named values set. definition: name -> {"bits": first or [first, ...], "values": {raw: label}}."""
    mask = 0
    for name, wanted in flags.items():
        d = definition[name]
        bits = d["bits"] if isinstance(d["bits"], (list, tuple)) else [d["bits"]]
        raw = next((int(k) for k, v in d["values"].items() if v == wanted), wanted if not isinstance(wanted, str) else None)
        if raw is None:
            raise ValueError(f"{name} has no value {wanted!r}")
        mask |= int(raw) << min(bits)
    return mask


def any_bit(band: Column | str, mask: int) -> Column:
    return as_column(band).bitwiseAND(F.lit(mask)) != 0


def no_bit(band: Column | str, mask: int) -> Column:
    return as_column(band).bitwiseAND(F.lit(mask)) == 0


def bit_field(band: Column | str, first: int, count: int) -> Column:
    return F.shiftright(as_column(band), first).bitwiseAND(F.lit((1 << count) - 1))


def in_classes(band: Column | str, classes: Iterable, names: dict | None = None) -> Column:
    """Class test by number or by name (names: number -> name)."""
    by_name = {v: k for k, v in (names or {}).items()}
    return as_column(band).isin([by_name.get(c, c) for c in classes])


def keep(value: Column | str, good: Column) -> Column:
    return F.when(good, as_column(value))


def erase(value: Column | str, bad: Column) -> Column:
    return F.when(~F.coalesce(bad, F.lit(False)), as_column(value))


def divided(a: Column | str, b: Column | str) -> Column:
    return as_column(a) / F.nullif(as_column(b), F.lit(0))


def clip(value: Column | str, low, high) -> Column:
    v = as_column(value)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(low)), F.lit(high)))


def linear(bands: Iterable[str], weights: Iterable[float]) -> Column:
    return fold(lambda a, b: a + b, [F.col(b) * F.lit(w) for b, w in zip(bands, weights, strict=True)])


def norm(bands: Iterable[str], least: float = 1e-8) -> Column:
    return F.greatest(F.sqrt(fold(lambda a, b: a + b, [F.col(b) * F.col(b) for b in bands])), F.lit(least))


def rgba(bands: tuple[str, str, str], low: float = 1, high: float = 3000) -> Column:
    """Struct r, g, b, a of 0..255; a is 0 where a band is missing or at its sentinel."""
    level = lambda b: F.coalesce(F.rint((F.least(F.greatest(F.col(b), F.lit(low)), F.lit(high)) - low) * 255.0 / (high - low)).cast("short"), F.lit(0).cast("short"))
    seen = fold(lambda a, b: a & b, [F.col(b).isNotNull() for b in bands])
    return F.struct(*[level(b).alias(n) for b, n in zip(bands, "rgb", strict=True)], F.when(seen, 255).otherwise(0).cast("short").alias("a"))


def _nd(a: str, b: str) -> Column:
    return divided(F.col(a) - F.col(b), F.col(a) + F.col(b))


def spectral_indices() -> dict[str, Column]:
    """The eight indices over columns blue, green, red, nir, swir1, swir2."""
    b, g, r, n, s1, s2 = (F.col(c) for c in ("blue", "green", "red", "nir", "swir1", "swir2"))
    return {
        "mndwi": _nd("green", "swir1"),
        "bui": _nd("swir1", "nir") - _nd("nir", "red"),
        "bsi": divided((s1 + r) - (n + b), (s1 + r) + (n + b)),
        "tcw": linear(("blue", "green", "red", "nir", "swir1", "swir2"), TASSELLED_CAP["wet"]),
        "ndmi": _nd("nir", "swir1"),
        "awei_sh": b + 2.5 * g - 1.5 * (n + s1) - 0.25 * s2,
        "baei": divided(r + 0.3, g + s1),
        "ndsi": _nd("green", "swir1"),
    }
