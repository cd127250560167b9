"""Splitting events into routes by the prefix of their type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The side routes and their type prefixes, first match wins.
# ("acitiv" is spelled that way on purpose; "activity..." types match no side route.)
DEFAULT_ROUTES = (("flow", "flow"), ("acitiv", "acitiv"))
MAIN_ROUTE = "main"


def side_route(type_col: Column | str, routes=DEFAULT_ROUTES) -> Column:
    """Name of the first route whose prefix the type starts with, else null."""
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    expr = None
    for name, prefix in routes:
        cond = t.startswith(prefix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_route(df: DataFrame, type_col: str = "event_type", out_col: str = "route",
               routes=DEFAULT_ROUTES) -> DataFrame:
    """One column naming the side route (null: main stream only)."""
    return df.withColumn(out_col, side_route(type_col, routes))


def route_events(df: DataFrame, type_col: str = "event_type", out_col: str = "route",
                 routes=DEFAULT_ROUTES) -> DataFrame:
    """Every row once on the main route, plus once on its side route if any.

    A row with a null type goes to the main route only.
    """
    side = side_route(type_col, routes)
    targets = F.filter(F.array(F.lit(MAIN_ROUTE), side), lambda r: r.isNotNull())
    return df.withColumn(out_col, F.explode(targets))


def route_counts(routed: DataFrame, route_col: str = "route") -> DataFrame:
    return routed.groupBy(route_col).agg(F.count(F.lit(1)).alias("n"))
