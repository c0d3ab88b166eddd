"""Map projections as SQL text of doubles, so that columns are projected inside generated code.

Every projection has forward (degrees east and north to x, y) and inverse. Transverse Mercator is Krueger's series to the
fourth order, equal-area ones go through the authalic latitude; errors stay at a millimetre or so where they are used.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

Pair = tuple[str, str]


def number(v: float) -> str:
    """A literal that is a double in any SQL."""
    return f"({v:.17e})"


def _turned(degrees: str) -> str:
    """Degrees brought to -180 up to 180."""
    return f"({degrees} - 360e0 * floor(({degrees} + 180e0) / 360e0))"


@dataclass(frozen=True)
class Ellipsoid:
    a: float = 6378137.0
    e2: float = 0.006694379990141317  # WGS 84; GRS 80 differs by less than a tenth of a millimetre

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    def q_of(self, sine: float) -> float:
        e = self.e
        return (1 - self.e2) * (sine / (1 - self.e2 * sine * sine) - math.log((1 - e * sine) / (1 + e * sine)) / (2 * e))

    def q(self, sine: str) -> str:
        e = number(self.e)
        return f"({number(1 - self.e2)} * ({sine} / (1e0 - {number(self.e2)} * {sine} * {sine}) - ln((1e0 - {e} * {sine}) / (1e0 + {e} * {sine})) / {number(2 * self.e)}))"

    def latitude(self, q: str) -> str:
        """Degrees north of an authalic q."""
        b, e2 = f"asin(greatest(-1e0, least(1e0, {q} / {number(self.q_of(1.0))})))", self.e2
        terms = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780, 761 * e2**3 / 45360)
        return f"degrees({b} + " + " + ".join(f"{number(t)} * sin({2 * (i + 1)}e0 * {b})" for i, t in enumerate(terms)) + ")"


WGS84 = Ellipsoid()


@dataclass(frozen=True)
class Geographic:
    def forward(self, lon: str, lat: str) -> Pair:
        return lon, lat

    def inverse(self, x: str, y: str) -> Pair:
        return x, y


@dataclass(frozen=True)
class WebMercator:
    radius: float = 6378137.0

    def forward(self, lon: str, lat: str) -> Pair:
        r = number(self.radius)
        return f"({r} * radians({lon}))", f"({r} * ln(tan({number(math.pi / 4)} + radians({lat}) / 2e0)))"

    def inverse(self, x: str, y: str) -> Pair:
        r = number(self.radius)
        return _turned(f"degrees({x} / {r})"), f"degrees(2e0 * atan(exp({y} / {r})) - {number(math.pi / 2)})"


@dataclass(frozen=True)
class CylindricalEqualArea:
    parallel: float
    meridian: float = 0.0
    on: Ellipsoid = WGS84

    @property
    def k(self) -> float:
        s = math.sin(math.radians(self.parallel))
        return math.sqrt(1 - s * s) / math.sqrt(1 - self.on.e2 * s * s)

    def forward(self, lon: str, lat: str) -> Pair:
        sine = f"sin(radians({lat}))"
        return f"({number(self.on.a * self.k)} * radians({lon} - {number(self.meridian)}))", f"({number(self.on.a / (2 * self.k))} * {self.on.q(sine)})"

    def inverse(self, x: str, y: str) -> Pair:
        return _turned(f"({number(self.meridian)} + degrees({x} / {number(self.on.a * self.k)}))"), self.on.latitude(f"({y} * {number(2 * self.k / self.on.a)})")


@dataclass(frozen=True)
class Albers:
    parallels: tuple[float, float]
    origin: tuple[float, float]  # latitude, meridian
    on: Ellipsoid = WGS84

    def _constants(self) -> tuple[float, float, float]:
        sine = [math.sin(math.radians(p)) for p in self.parallels]
        m = [math.sqrt((1 - s * s) / (1 - self.on.e2 * s * s)) for s in sine]
        q = [self.on.q_of(s) for s in sine]
        n = (m[0] ** 2 - m[1] ** 2) / (q[1] - q[0])
        c = m[0] ** 2 + n * q[0]
        return n, c, self.on.a * math.sqrt(c - n * self.on.q_of(math.sin(math.radians(self.origin[0])))) / n

    def forward(self, lon: str, lat: str) -> Pair:
        n, c, rho0 = self._constants()
        rho = f"({number(self.on.a / n)} * sqrt({number(c)} - {number(n)} * {self.on.q(f'sin(radians({lat}))')}))"
        theta = f"({number(n)} * radians({_turned(f'({lon} - {number(self.origin[1])})')}))"
        return f"({rho} * sin({theta}))", f"({number(rho0)} - {rho} * cos({theta}))"

    def inverse(self, x: str, y: str) -> Pair:
        n, c, rho0 = self._constants()
        side = math.copysign(1.0, n)
        down = f"({number(rho0)} - {y})"
        theta = f"atan2({number(side)} * {x}, {number(side)} * {down})"
        q = f"(({number(c)} - ({x} * {x} + {down} * {down}) * {number((n / self.on.a) ** 2)}) / {number(n)})"
        return _turned(f"({number(self.origin[1])} + degrees({theta}) / {number(n)})"), self.on.latitude(q)


@dataclass(frozen=True)
class TransverseMercator:
    meridian: float
    scale: float = 0.9996
    false: tuple[float, float] = (500000.0, 0.0)
    on: Ellipsoid = WGS84

    def _series(self) -> tuple[float, float, tuple[float, ...], tuple[float, ...], tuple[float, ...]]:
        f = 1 - math.sqrt(1 - self.on.e2)
        n = f / (2 - f)
        radius = self.scale * self.on.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
        beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
        delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
        return n, radius, alpha, beta, delta

    def forward(self, lon: str, lat: str) -> Pair:
        n, radius, alpha, _, _ = self._series()
        k = number(2 * math.sqrt(n) / (1 + n))
        sine, east = f"sin(radians({lat}))", f"radians({lon} - {number(self.meridian)})"
        t = f"sinh(atanh({sine}) - {k} * atanh({k} * {sine}))"
        xi, eta = f"atan2({t}, cos({east}))", f"atanh(sin({east}) / sqrt(1e0 + {t} * {t}))"
        x = " + ".join([eta, *(f"{number(c)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, c in enumerate(alpha, 1))])
        y = " + ".join([xi, *(f"{number(c)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, c in enumerate(alpha, 1))])
        return f"({number(self.false[0])} + {number(radius)} * ({x}))", f"({number(self.false[1])} + {number(radius)} * ({y}))"

    def inverse(self, x: str, y: str) -> Pair:
        _, radius, _, beta, delta = self._series()
        xi, eta = f"(({y} - {number(self.false[1])}) / {number(radius)})", f"(({x} - {number(self.false[0])}) / {number(radius)})"
        up = "(" + " - ".join([xi, *(f"{number(c)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, c in enumerate(beta, 1))]) + ")"
        along = "(" + " - ".join([eta, *(f"{number(c)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, c in enumerate(beta, 1))]) + ")"
        chi = f"asin(sin({up}) / cosh({along}))"
        lat = " + ".join([chi, *(f"{number(c)} * sin({2 * j}e0 * {chi})" for j, c in enumerate(delta, 1))])
        return _turned(f"({number(self.meridian)} + degrees(atan2(sinh({along}), cos({up}))))"), f"degrees({lat})"


Projection = Geographic | WebMercator | CylindricalEqualArea | Albers | TransverseMercator


def projection(crs: str) -> Projection:
    """Of EPSG codes: 4326, 3857, 6933, 3577 and the zones 326xx and 327xx."""
    code = crs.upper().removeprefix("EPSG:")
    if code in ("4326", "3857"):
        return Geographic() if code == "4326" else WebMercator()
    if code == "6933":
        return CylindricalEqualArea(30.0)
    if code == "3577":
        return Albers((-18.0, -36.0), (0.0, 132.0))
    if (zone := re.fullmatch(r"32([67])(\d\d)", code)) and 1 <= int(zone[2]) <= 60:
        return TransverseMercator(6.0 * int(zone[2]) - 183.0, false=(500000.0, 0.0 if zone[1] == "6" else 10000000.0))
    raise ValueError(f"no projection of {crs}")


def between(source: str, target: str, x: str, y: str) -> Pair:
    """A point of one system in another; x and y are names or numbers, as they are repeated."""
    if source.upper() == target.upper():
        return x, y
    return projection(target).forward(*projection(source).inverse(x, y))
