"""Transverse Mercator projection as column expressions.

The expansion is the Kruger series in the third flattening, public in the map projection
literature. Parameters describe a grid; :data:`SVY21` is the one of EPSG:3414.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class TransverseMercator:
    latitude_origin: float
    longitude_origin: float
    false_easting: float
    false_northing: float
    scale: float = 1.0
    semi_major: float = 6_378_137.0
    inverse_flattening: float = 298.257223563

    @property
    def third_flattening(self) -> float:
        f = 1.0 / self.inverse_flattening
        return f / (2.0 - f)

    @property
    def rectifying_radius(self) -> float:
        n = self.third_flattening
        return self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def coefficients(self) -> tuple[float, float, float]:
        n = self.third_flattening
        return (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)

    @property
    def eccentricity(self) -> float:
        n = self.third_flattening
        return 2 * math.sqrt(n) / (1 + n)

    @property
    def origin_northing(self) -> float:
        """Rectified arc from the equator to the origin latitude."""
        e = self.eccentricity
        sine = math.sin(math.radians(self.latitude_origin))
        xi = math.atan(math.sinh(math.atanh(sine) - e * math.atanh(e * sine)))
        arc = xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(self.coefficients, 1))
        return self.scale * self.rectifying_radius * arc


# The published parameters of EPSG:3414.
SVY21 = TransverseMercator(1.0 + 22.0 / 60.0, 103.0 + 50.0 / 60.0, 28_001.642, 38_744.572)


def project(latitude: Column, longitude: Column, tm: TransverseMercator) -> tuple[Column, Column]:
    """Easting and northing, in metres."""
    e = F.lit(tm.eccentricity)
    sine = F.sin(F.radians(latitude))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    away = F.radians(longitude - F.lit(tm.longitude_origin))
    xi = F.atan2(t, F.cos(away))
    eta = F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(tm.coefficients, 1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    radius = tm.scale * tm.rectifying_radius
    return (F.lit(tm.false_easting) + F.lit(radius) * east,
            F.lit(tm.false_northing - tm.origin_northing) + F.lit(radius) * north)
