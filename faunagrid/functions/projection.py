"""The Robinson projection of a map, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the projection: for every 5 degrees of latitude from 0 to 90 the length of the parallel and its distance
# from the equator, the factors of both, and the radius in metres (the semi-major axis of WGS 84).
LENGTH = (1.0, 0.9986, 0.9954, 0.99, 0.9822, 0.973, 0.96, 0.9427, 0.9216, 0.8962, 0.8679, 0.835, 0.7986, 0.7597, 0.7186, 0.6732, 0.6213, 0.5722, 0.5322)
DISTANCE = (0.0, 0.062, 0.124, 0.186, 0.248, 0.31, 0.372, 0.434, 0.4958, 0.5571, 0.6176, 0.6769, 0.7346, 0.7903, 0.8435, 0.8936, 0.9394, 0.9761, 1.0)
FACTORS = (0.8487, 1.3523)
RADIUS = 6378137.0


def _between(values: tuple[float, ...], mirrored: float, at: Column) -> Column:
    """The cubic through the four values around ``at`` (in steps of 5 degrees); below the equator they are mirrored."""
    known = F.array(*map(F.lit, (mirrored, *values)))
    first = F.least(F.floor(at), F.lit(16)).cast("int")  # the second of the four, in ``known``
    t = at - first + 1
    a, b, c, d = (F.element_at(known, first + k) for k in (1, 2, 3, 4))
    return -a * (t - 1) * (t - 2) * (t - 3) / 6 + b * t * (t - 2) * (t - 3) / 2 - c * t * (t - 1) * (t - 3) / 2 + d * t * (t - 1) * (t - 2) / 6


def robinson(lng: Column, lat: Column, centre: float = 0.0) -> tuple[Column, Column]:
    """x and y in metres of places in degrees, on a map around the meridian ``centre``; NULL off the globe."""
    at = F.abs(lat.cast("double")) / 5
    turn = lng.cast("double") - centre
    turn = F.when(F.abs(turn) <= 180, turn).otherwise(F.pmod(turn + 180, F.lit(360.0)) - 180)
    good = at <= 18
    x = F.lit(FACTORS[0] * RADIUS * math.pi / 180) * _between(LENGTH, LENGTH[1], at) * turn
    y = F.lit(FACTORS[1] * RADIUS) * _between(DISTANCE, -DISTANCE[1], at) * F.signum(lat.cast("double"))
    return F.when(good, x), F.when(good, y)
