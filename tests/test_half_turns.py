"""Queries over headings against DuckDB where headings and steps are half turns and whole ones, to the last bit."""

import datetime
import random

import duckdb
import pytest

from lumenvox.plans import catalogue

USERS, EVENTS = 120, 40


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    rng, rows = random.Random(5), []
    for user in range(USERS):
        value = round(rng.uniform(0, 300), 2)
        for i in range(EVENTS):
            # half a turn further, a multiple of half a turn, or anything
            value = rng.choice([round(value + rng.choice([50, -50, 150]), 2), 50.0 * rng.randint(0, 9), round(rng.uniform(0, 300), 2)])
            rows.append((user * EVENTS + i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i), user, "view", value, "{}"))
    folder = tmp_path_factory.mktemp("half_turns")
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["unwrap", "yaw_rate_limit", "ema_clamp", "capture_headings"])
def test_half_turns(spark, events, name):
    mine = catalogue.queries()[name](spark, events)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{events}/events.parquet/*.parquet'")
    theirs = con.sql(f"SELECT {', '.join(mine.columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    found = sorted(tuple(r) for r in mine.collect())
    assert len(found) == len(theirs) > 0
    assert [r for r, s in zip(found, sorted(theirs), strict=True) if r != s] == []
