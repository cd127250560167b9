"""Geohash as a pure Column expression (no UDF, stays inside codegen).

A precision-``p`` geohash interleaves ``ceil(5p/2)`` longitude bits with
``floor(5p/2)`` latitude bits, longitude first, and spells the result five
bits per character.  Bisection of ``[-180, 180]`` into ``2**k`` cells is the
same as ``floor((lon + 180) * 2**k / 360)`` clamped to ``2**k - 1`` (the top
edge belongs to the last cell), so every bit comes from one integer; the
index is checked against the exact cell edges to stay equal to bisection
where floating-point rounding would move it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The geohash base-32 alphabet, in order.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _cell_index(value: Column, lo: float, span: float, bits: int) -> Column:
    n = 1 << bits
    width = span / n  # an exact binary fraction for the spans used here
    raw = F.floor((value - F.lit(lo)) * F.lit(float(n)) / F.lit(span)).cast("long")
    # The closed form can be one cell off when ``value - lo`` rounds (e.g. a
    # tiny negative longitude); cell edges are exact, so compare and correct.
    edge = F.lit(lo) + raw.cast("double") * F.lit(width)
    fixed = (F.when(value < edge, raw - 1)
             .when(value >= edge + F.lit(width), raw + 1)
             .otherwise(raw))
    return F.least(F.lit(n - 1).cast("long"), F.greatest(F.lit(0).cast("long"), fixed))


def _bits(precision: int) -> tuple[int, int]:
    total = 5 * precision
    return (total + 1) // 2, total // 2


def cell_indices(lat: Column | str, lon: Column | str, precision: int = 5) -> tuple[Column, Column]:
    """(longitude cell, latitude cell) integers of the geohash grid."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    lon_bits, lat_bits = _bits(precision)
    return _cell_index(lon, -180.0, 360.0, lon_bits), _cell_index(lat, -90.0, 180.0, lat_bits)


def spell(x: Column, y: Column, precision: int = 5) -> Column:
    """Geohash text from the two cell integers (bit interleave, base 32)."""
    lon_bits, lat_bits = _bits(precision)
    stream = []
    xi, yi = lon_bits - 1, lat_bits - 1
    for pos in range(5 * precision):
        if pos % 2 == 0:  # the stream starts with the most significant longitude bit
            stream.append((x, xi))
            xi -= 1
        else:
            stream.append((y, yi))
            yi -= 1
    chars = []
    for c in range(precision):
        digit = None
        for j in range(5):
            src, bit = stream[5 * c + j]
            term = F.shiftright(src, bit).bitwiseAND(F.lit(1)) * F.lit(1 << (4 - j))
            digit = term if digit is None else digit + term
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (digit + F.lit(1)).cast("int"), 1))
    return F.concat(*chars)


def _in_range(lat: Column | str, lon: Column | str) -> Column:
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def geohash(lat: Column | str, lon: Column | str, precision: int = 5) -> Column:
    """Base-32 geohash of (lat, lon); null when either is null or out of range.

    A single Column: the two cell integers are bound to a lambda variable so
    each is computed once per row (an inline form would repeat them in all
    ``5 * precision`` bit terms).  Pipelines use ``with_geohash``, which
    stages the integers as columns and stays inside whole-stage codegen.
    """
    x, y = cell_indices(lat, lon, precision)
    cells = F.array(F.struct(x.alias("x"), y.alias("y")))
    text = F.transform(cells, lambda s: spell(s["x"], s["y"], precision))[0]
    return F.when(_in_range(lat, lon), text)


def geohash5(lat: Column | str, lon: Column | str) -> Column:
    return geohash(lat, lon, 5)


def with_geohash(df: DataFrame, lat: str, lon: str, out_col: str = "geohash5",
                 precision: int = 5) -> DataFrame:
    """Add the geohash of (lat, lon) as ``out_col`` (codegen-friendly staged form)."""
    x, y = cell_indices(lat, lon, precision)
    staged = df.withColumns({"_gh_x": x, "_gh_y": y})
    text = F.when(_in_range(lat, lon), spell(F.col("_gh_x"), F.col("_gh_y"), precision))
    return staged.withColumn(out_col, text).drop("_gh_x", "_gh_y")
