"""Place enrichment by geohash cell, with a cache-aside fill for unknown cells.

The place dictionary is a table ``(geohash5, province, city, district)``.
Instead of one blocking lookup (and possibly one geocoder call) per event,
we join the facts with the dictionary, collect the *distinct* unknown cells
with one representative coordinate each, resolve only those, and append
them to the dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.functions.geohash import with_geohash
from driftlog.functions.text import empty_to_null, json_text_field, null_or_empty, split_drop_trailing
from driftlog.operators.joins import lookup_join, stage_table

PLACE_COLS = ("province", "city", "district")

Resolver = Callable[[DataFrame], DataFrame]


def with_geohash5(df: DataFrame, lat: str = "lat", lon: str = "lon",
                  out_col: str = "geohash5") -> DataFrame:
    return with_geohash(df, lat, lon, out_col)


def known_places(places: DataFrame) -> DataFrame:
    """Dictionary rows that count as hits (an entry stored as empty text is a miss)."""
    empty = null_or_empty("province") & null_or_empty("city") & null_or_empty("district")
    return places.where(F.col("geohash5").isNotNull() & ~empty)


def enrich_places(facts: DataFrame, places: DataFrame, cell: str = "geohash5") -> DataFrame:
    """Left join on the cell; place columns of the facts are replaced."""
    dim = places.select(F.col("geohash5").alias(cell), *PLACE_COLS)
    base = facts.drop(*[c for c in PLACE_COLS if c in facts.columns])
    return lookup_join(base, dim, cell, "left")


def missing_cells(facts: DataFrame, places: DataFrame, seq: str | tuple[str, ...] = "seq", cell: str = "geohash5",
                  lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Distinct cells of the facts absent from the dictionary, each with the
    coordinates of its first event (by ``seq``, one or more order columns).

    Facts are reduced per cell first (partial aggregation, so a hot cell is
    combined map-side), and only the per-cell rows meet the dictionary.  With
    several order columns (batch, place in the batch) the facts are reduced
    per cell and leading columns by the last one.
    """
    # Primitive min_by's (the order is unique, so both pick the same row) keep
    # the aggregation of the facts hash-based.
    lead, last = (seq[:-1], seq[-1]) if isinstance(seq, tuple) else ((), seq)
    first = (facts.where(F.col(cell).isNotNull())
             .groupBy(cell, *lead)
             .agg(F.min_by(lon, last).alias("lon"), F.min_by(lat, last).alias("lat")))
    if lead:
        by = F.struct(*lead) if len(lead) > 1 else F.col(lead[0])
        first = first.groupBy(cell).agg(F.min_by("lon", by).alias("lon"), F.min_by("lat", by).alias("lat"))
    known = known_places(places).select(F.col("geohash5").alias(cell))
    return (first.join(known, cell, "left_anti")
            .select(F.col(cell).alias("geohash5"), "lon", "lat"))


def resolve_missing(facts: DataFrame, places: DataFrame, resolver: Resolver,
                    seq: str | tuple[str, ...] = "seq", cell: str = "geohash5", lat: str = "lat",
                    lon: str = "lon") -> DataFrame:
    """One row ``(geohash5, province, city, district)`` per new cell.

    ``resolver`` maps ``(geohash5, lon, lat)`` rows to
    ``(geohash5, province, city, district)`` -- e.g. ``geocoder_resolver``
    around an HTTP client, or a table-driven rule in tests.  The result is
    lazy: write it once if it is used twice, or the resolver is called twice.
    """
    return resolver(missing_cells(facts, places, seq, cell, lat, lon)).select("geohash5", *PLACE_COLS)


def fill_place_cache(facts: DataFrame, places: DataFrame, resolver: Resolver,
                     seq: str | tuple[str, ...] = "seq", cell: str = "geohash5", lat: str = "lat",
                     lon: str = "lon") -> DataFrame:
    """The grown dictionary: known entries plus one resolved entry per new cell."""
    new = resolve_missing(facts, places, resolver, seq, cell, lat, lon)
    return known_places(places).select("geohash5", *PLACE_COLS).unionByName(new)


def enrich_with_fill(facts: DataFrame, places: DataFrame, resolver: Resolver, seq: str | tuple[str, ...] = "seq",
                     lat: str = "lat", lon: str = "lon") -> tuple[DataFrame, DataFrame]:
    """Cache-aside enrichment: returns (enriched facts, grown dictionary).

    Facts are read twice, for their new cells and for the join; stage them first if
    they cost more to derive (parsed text, decoded batches) than to write.

    The new entries are written to the shared folder once and read back, so
    the resolver is called once per cell however often the results are read,
    and rows and dictionary agree.
    """
    geo = facts if "geohash5" in facts.columns else with_geohash5(facts, lat, lon)
    new = stage_table(resolve_missing(geo, places, resolver, seq, "geohash5", lat, lon), "new_places")
    grown = known_places(places).select("geohash5", *PLACE_COLS).unionByName(new)
    return enrich_places(geo, grown), grown


def parse_geocoder_response(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """Reverse-geocoder JSON -> place columns.

    Reads ``regeocode.addressComponent.{province, city, district}``; a city
    that is not plain text (an empty list for municipalities) or is empty
    becomes null.
    """
    base = "$.regeocode.addressComponent."
    doc = F.col(response_col)
    return responses.select(
        F.col("geohash5"),
        empty_to_null(F.get_json_object(doc, base + "province")).alias("province"),
        json_text_field(doc, base + "city").alias("city"),
        empty_to_null(F.get_json_object(doc, base + "district")).alias("district"),
    )


def encode_place_text(places: DataFrame, out_col: str = "text") -> DataFrame:
    """Place columns -> ``province,city,district`` text (nulls written as empty fields)."""
    return places.select("geohash5", F.concat_ws(",", *[F.coalesce(F.col(c), F.lit(""))
                                                        for c in PLACE_COLS]).alias(out_col))


def decode_place_text(encoded: DataFrame, text_col: str = "text") -> DataFrame:
    """``province,city,district`` text -> columns; missing or empty fields are null."""
    parts = split_drop_trailing(F.col(text_col), ",")
    return encoded.select("geohash5", *[empty_to_null(F.get(parts, i)).alias(c)
                                        for i, c in enumerate(PLACE_COLS)])


def geocoder_resolver(client_factory: Callable[[], Callable[[float, float], str]],
                      ) -> Resolver:
    """Resolver that calls a reverse geocoder once per *new cell*.

    ``client_factory`` runs once per partition on the executor and returns
    ``fetch(lon, lat) -> response JSON``.  Calls happen in ``mapInPandas``
    batches; responses are parsed with ``parse_geocoder_response``.
    """
    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = client_factory()
        for pdf in batches:
            yield pd.DataFrame({
                "geohash5": pdf["geohash5"],
                "response": [fetch(lo, la) for lo, la in zip(pdf["lon"], pdf["lat"])],
            })

    def resolve(cells: DataFrame) -> DataFrame:
        landed = cells.mapInPandas(call, "geohash5 string, response string")
        return parse_geocoder_response(landed)

    return resolve
