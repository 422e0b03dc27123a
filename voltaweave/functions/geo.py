"""Inverse transverse Mercator (UTM, GRS80) by Krüger's series, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80, and the constants of UTM.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
SCALE, FALSE_EASTING = 0.9996, 500000.0
#: Provinces of zone 28, lower-cased; all others lie in zone 30.
CANARY_PROVINCES = ["palmas, las", "santa cruz de tenerife"]
#: Longitudes and latitudes that a result may have.
BOUNDS = (-18.0, 5.0, 27.0, 44.0)

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
]
_DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
]


def _let(value: Column, then) -> Column:
    """``then(value)``, with the value computed once however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _series(p: Column) -> Column:
    xi, eta = p["xi"], p["eta"]
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.struct(xi1.alias("xi"), eta1.alias("eta"))


def _latitude(chi: Column) -> Column:
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return lat


def unprojected(x: Column, y: Column, central_meridian: Column) -> Column:
    """A struct of lat and lon in degrees, of easting and northing (northern hemisphere)."""

    def places(q: Column) -> Column:
        lat = _let(F.asin(F.sin(q["xi"]) / F.cosh(q["eta"])), _latitude)
        lon = central_meridian + F.degrees(F.atan2(F.sinh(q["eta"]), F.cos(q["xi"])))
        return F.struct(F.degrees(lat).alias("lat"), lon.alias("lon"))

    ratios = F.struct((y / (SCALE * _RADIUS)).alias("xi"), ((x - FALSE_EASTING) / (SCALE * _RADIUS)).alias("eta"))
    return _let(ratios, lambda p: _let(_series(p), places))


def place(x: Column, y: Column, province: Column) -> Column:
    """A struct of lat and lon to six places, both null for missing input or a place outside the bounds."""
    meridian = F.when(F.lower(province).isin(*CANARY_PROVINCES), -15.0).otherwise(-3.0)
    west, east, south, north = BOUNDS

    def bounded(p: Column) -> Column:
        good = p["lon"].between(west, east) & p["lat"].between(south, north)
        return F.struct(F.when(good, F.round(p["lat"], 6)).alias("lat"), F.when(good, F.round(p["lon"], 6)).alias("lon"))

    return _let(unprojected(x, y, meridian), bounded)


def lat_lon(x: Column, y: Column, province: Column) -> tuple[Column, Column]:
    """The two fields of :func:`place`."""
    found = place(x, y, province)
    return found["lat"], found["lon"]
