import json
import os

import pytest
from pyspark.errors import PySparkException

from driftlog.operators.dictionary import (incremental_poll, latest_names, lookup_event_names,
                                           poll_order_names, resolve_polls)
from driftlog.sources.dictionary import DictionaryPoller, jdbc_options

DICT = [("1", "view_a", "2024-01-01"), ("1", "view_b", "2024-01-03"), ("1", "view_c", "2024-01-02"),
        ("2", "click_a", "2024-01-01")]


def _dict(spark, rows=DICT):
    return spark.createDataFrame(rows, "event_id string, event_name string, last_update string")


def test_latest_and_poll_order(spark):
    d = _dict(spark)
    assert dict(latest_names(d).collect()) == {"1": "view_b", "2": "click_a"}
    assert dict(poll_order_names(d).collect()) == {"1": "view_a", "2": "click_a"}


def test_resolve_polls_across_polls(spark):
    polls = spark.createDataFrame(
        [(1, "1", "old", "2024-01-01"), (1, "1", "older", "2024-01-00"), (2, "1", "renamed", "2024-01-05")],
        "poll_id long, event_id string, event_name string, last_update string")
    assert dict(resolve_polls(polls, order="poll").collect()) == {"1": "renamed"}
    first = polls.where("poll_id = 1")
    assert dict(resolve_polls(first, order="poll").collect()) == {"1": "older"}
    assert dict(resolve_polls(first, order="newest").collect()) == {"1": "old"}


def test_incremental_poll_strict_and_inclusive(spark):
    d = _dict(spark)
    assert incremental_poll(d, "2024-01-02").count() == 1
    assert incremental_poll(d, "2024-01-02", inclusive=True).count() == 2
    assert incremental_poll(d, None).count() == 4


def test_poller_advances_its_bound(spark):
    rows = list(DICT)
    p = DictionaryPoller(lambda: _dict(spark, rows))
    assert p.poll().count() == len(DICT)
    top = max(r[2] for r in DICT)
    assert p.bound == top and p.poll().count() == 0
    rows.append(("9", "late", top))
    assert DictionaryPoller(lambda: _dict(spark, rows), first_bound=top, inclusive=True).poll().count() >= 1
    assert DictionaryPoller(lambda: _dict(spark, rows), first_bound=top).poll().count() == 0


def test_lookup_missing_policies(spark):
    names = latest_names(_dict(spark))
    facts = spark.createDataFrame([(0, "1"), (1, "9")], "seq long, type_id string")
    got = {r.seq: r.event_type_name for r in lookup_event_names(facts, names).collect()}
    assert got == {0: "view_b", 1: None}
    assert lookup_event_names(facts, names, on_missing="drop").count() == 1
    with pytest.raises(PySparkException):
        lookup_event_names(facts, names, on_missing="error").collect()
    # Beyond the broadcast bytes the same result comes from a shuffle join.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup_event_names(facts, names).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.seq: r.event_type_name for r in big} == got


def test_jdbc_options_carry_no_defaults():
    o = jdbc_options("jdbc:mysql://db/demo", "tb_event_name")
    assert o["dbtable"] == "tb_event_name" and "user" not in o and "password" not in o


def test_incremental_names_merge_polls(spark, workdir):
    from driftlog.sources.dictionary import IncrementalNames
    rows = list(DICT)
    inc = IncrementalNames(spark, lambda: _dict(spark, rows), os.path.join(workdir, "names"))
    v0 = {r.event_id: r.event_name for r in inc.refresh(0).collect()}
    assert v0 == {"1": "view_b", "2": "click_a"}
    rows += [("2", "click_b", "2024-01-05"), ("3", "buy", "2024-01-06")]
    v1 = {r.event_id: r.event_name for r in inc.refresh(1).collect()}
    assert v1 == {"1": "view_b", "2": "click_b", "3": "buy"}
    assert {r.event_id: r.event_name for r in inc.refresh(2).collect()} == v1
    # A new process finds the last version and polls past its bound only.
    again = IncrementalNames(spark, lambda: _dict(spark, [("1", "view_c", "2024-02-01"), ("3", "old", "2024-01-02")]),
                             os.path.join(workdir, "names"))
    v3 = {r.event_id: r.event_name for r in again.refresh(3).collect()}
    assert v3 == {"1": "view_c", "2": "click_b", "3": "buy"}
    # A version that is written again starts from the one before it.
    assert {r.event_id: r.event_name for r in again.refresh(3).collect()} == v3
    # Only the last versions stay.
    assert sorted(d for d in os.listdir(os.path.join(workdir, "names"))) == ["version=1", "version=2", "version=3"]
