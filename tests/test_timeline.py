"""Access timelines against looking at every minute, with whole and cut users."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from lustra.functions.codes import ACCESS_LEVELS
from lustra.operators.as_of import as_of_join
from lustra.operators.grants import in_force, resolve_all_levels
from lustra.operators.history import END, START, versions_as_of
from lustra.operators.skew import SkewPolicy
from lustra.operators.timeline import access_timeline

FIELDS = "user_email string, access_level string, granted_at timestamp_ntz, expires_at timestamp_ntz, is_active boolean"
ZERO = dt.datetime(2024, 1, 1)


def at(minute):
    return None if minute is None else ZERO + dt.timedelta(minutes=minute)


def random_grants(seed, n=120, users="aabc"):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = rng.choice([*range(40), None]) if rng.random() < 0.1 else rng.randrange(40)
        end = None if rng.random() < 0.05 else (start or 0) + rng.randrange(-2, 6)
        level = rng.choice([*ACCESS_LEVELS, "other"])
        rows.append((rng.choice(users), level, at(start), at(end), rng.random() < 0.9))
    return [*rows, (None, "full_access", at(1), None, True), ("d", "masked_only", at(3), None, True)]


def level_at(rows, user, minute):
    now = at(minute)
    held = [
        ACCESS_LEVELS.index(level) if level in ACCESS_LEVELS else 0
        for who, level, start, end, active in rows
        if who == user and active and start is not None and start <= now and (end is None or end > now)
    ]
    return ACCESS_LEVELS[max(held, default=0)]


@pytest.mark.parametrize("skew", [None, SkewPolicy(), SkewPolicy(hot_rows=10, range_rows=5)])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_timeline_equals_every_minute(spark, seed, skew):
    rows = random_grants(seed)
    line = [tuple(r) for r in access_timeline(spark.createDataFrame(rows, FIELDS), skew).collect()]
    for user in "abcde":
        own = sorted((r for r in line if r[0] == user), key=lambda r: r[2])
        for minute in range(50):
            found = [r[1] for r in own if r[2] <= at(minute) and (r[3] is None or r[3] > at(minute))]
            assert len(found) <= 1
            assert (found or [ACCESS_LEVELS[0]])[0] == level_at(rows, user, minute)
        assert all(a[3] == b[2] and a[1] != b[1] for a, b in zip(own, own[1:]))
        assert not own or own[-1][3] is None
    assert [r[:2] for r in line if r[0] == "d"] == [("d", "masked_only")]


def test_lookup_equals_resolving_at_that_time(spark):
    grants = spark.createDataFrame(random_grants(9), FIELDS)
    line = access_timeline(grants)
    now = F.lit(str(at(17))).cast("timestamp_ntz")
    started = grants.filter("user_email IS NOT NULL").withColumn("is_active", in_force(now, respect_granted_at=True))
    want = {tuple(r) for r in resolve_all_levels(started, now).collect() if r[1] != ACCESS_LEVELS[0]}
    have = {tuple(r[:2]) for r in versions_as_of(line, str(at(17))).collect()}
    assert {r for r in have if r[1] != ACCESS_LEVELS[0]} == want
    reads = spark.createDataFrame([("a", at(m)) for m in range(45)], "user_email string, read_at timestamp_ntz")
    seen = as_of_join(reads, line, ["user_email"], "read_at").collect()
    rows = random_grants(9)
    assert all((r.access_level or ACCESS_LEVELS[0]) == level_at(rows, "a", (r.read_at - ZERO).seconds // 60) for r in seen)


def test_no_grants_and_one_sweep(spark):
    none = spark.createDataFrame([], FIELDS)
    assert access_timeline(none).isEmpty() and access_timeline(none).columns == ["user_email", "access_level", START, END]
    plan = access_timeline(spark.createDataFrame(random_grants(1), FIELDS), skew=None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and len(re.findall(r"Exchange hashpartitioning", text)) == 2
