"""DataFrame -> DataFrame operators (batch and streaming unless noted)."""

from driftlog.operators.asof import asof_join
from driftlog.operators.cubes import cube_sets, grouping_sets, rollup_sets
from driftlog.operators.decode import encode_json_events, parse_csv_events, parse_json_events
from driftlog.operators.dictionary import (incremental_poll, latest_names, lookup_event_names,
                                           poll_order_names, resolve_polls)
from driftlog.operators.intervals import interval_join
from driftlog.operators.joins import lookup_join, stage_table, staged_for
from driftlog.operators.metrics import (active_users, activity_scoreboard, key_summary, latest_per_key,
                                        page_views, running_count, scoreboard_from_summary)
from driftlog.operators.places import (decode_place_text, encode_place_text, enrich_places, enrich_with_fill,
                                       fill_place_cache, geocoder_resolver, missing_cells,
                                       parse_geocoder_response, with_geohash5)
from driftlog.operators.route import route_counts, route_events, side_route, with_route
from driftlog.operators.sessions import sessionize
from driftlog.operators.sinks import (kv_table, read_archive, to_topic_records, with_archive_bucket,
                                      write_archive, write_changes)
from driftlog.operators.sketches import estimate, roll_up, user_sketches
from driftlog.operators.topk import heavy_hitters, top_k
from driftlog.operators.windows import windowed_counts

__all__ = [
    "encode_json_events", "parse_csv_events", "parse_json_events",
    "incremental_poll", "latest_names", "lookup_event_names", "poll_order_names", "resolve_polls",
    "lookup_join", "stage_table", "staged_for",
    "active_users", "activity_scoreboard", "key_summary", "latest_per_key", "page_views", "running_count",
    "scoreboard_from_summary",
    "decode_place_text", "encode_place_text", "enrich_places", "enrich_with_fill", "fill_place_cache",
    "geocoder_resolver", "missing_cells", "parse_geocoder_response", "with_geohash5",
    "route_counts", "route_events", "side_route", "with_route",
    "kv_table", "read_archive", "to_topic_records", "with_archive_bucket", "write_archive", "write_changes",
    "asof_join", "interval_join", "sessionize", "windowed_counts",
    "user_sketches", "roll_up", "estimate", "cube_sets", "rollup_sets", "grouping_sets", "top_k", "heavy_hitters",
]
