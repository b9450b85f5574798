"""Cron masks and due minutes against a plain walk over the minutes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import write_pages
from tributary.plans import PipelineSpec, Runner, SourceSpec
from tributary.plans.schedules import FIELDS, cron_masks, due, field_mask
from tributary.session import scratch_dir, unique_name


def values(field, lo, hi):
    out = set()
    for item in field.split(","):
        span, _, step = item.partition("/")
        if span == "*":
            a, b = lo, hi
        elif "-" in span:
            a, b = map(int, span.split("-"))
        else:
            a = int(span)
            b = hi if step else a
        by = int(step) if step else 1
        if not (lo <= a <= b <= hi) or by < 1:
            raise ValueError(item)
        out |= set(range(a, b + 1, by))
    return out


def fits(schedule, t):
    raw = schedule.split()
    m, h, d, mo, w = (values(f, lo, hi) for f, (_, lo, hi) in zip(raw, FIELDS))
    w = {x % 7 for x in w}
    day, week = t.day in d, (t.isoweekday() % 7) in w
    either = (day and week) if raw[2].startswith("*") or raw[4].startswith("*") else (day or week)
    return t.minute in m and t.hour in h and t.month in mo and either


GOOD = ["* * * * *", "*/15 * * * *", "0 0 * * *", "5,35 3 29 2 *", "30 6 1-15/7 * 7", "10/20 23 * 3-12 0,6", "0 12 13 * 5", "0 12 */2 * 1",
        "59 23 31 12 *", "1-5,7,50-59/3 */5 * * 1-5", "0 0 30 2 *", "0 4 * * 0-7"]
BAD = ["99 99 * * *", "60 * * * *", "* 24 * * *", "* * 0 * *", "* * * 13 *", "* * * * 8", "5-3 * * * *", "*/0 * * * *", "1--2 * * * *",
       ", * * * *", "*-3 * * * *", "1/2/3 * * * *", "- * * * *", "123456 * * * *"]
RANGES = [(dt.datetime(2024, 2, 27, 10, 7, 30), dt.datetime(2024, 3, 4, 6, 30)), (dt.datetime(2023, 12, 31, 23, 58), dt.datetime(2024, 1, 1, 0, 2)),
          (dt.datetime(2024, 5, 5, 5, 5), dt.datetime(2024, 5, 5, 5, 5)), (dt.datetime(2024, 5, 5, 5, 5), dt.datetime(2024, 5, 5, 5, 6)),
          (dt.datetime(2024, 5, 5, 0, 0), dt.datetime(2024, 5, 6, 0, 0)), (dt.datetime(2024, 5, 5, 5, 5, 1), dt.datetime(2024, 5, 5, 5, 6, 1))]


@pytest.mark.parametrize("start,stop", RANGES)
def test_due_minutes_equal_a_walk(spark, start, stop):
    rows = spark.createDataFrame([(s,) for s in GOOD], "schedule string")
    got = {r.schedule: (r.valid_schedule, r.n_due, r.first_due, r.last_due) for r in due(rows, start, stop).collect()}
    walk, t = [], start.replace(second=0, microsecond=0)
    while t < stop:
        if t >= start:
            walk.append(t)
        t += dt.timedelta(minutes=1)
    for s in GOOD:
        hits = [t for t in walk if fits(s, t)]
        assert got[s] == (True, len(hits), hits[0] if hits else None, hits[-1] if hits else None), s


def test_bad_fields_and_absent_schedules_are_never_due(spark):
    rows = spark.createDataFrame([(s,) for s in BAD + ["@daily", "* * * *", "", None]], "schedule string")
    for r in due(rows, *RANGES[0]).collect():
        assert (r.valid_schedule, r.n_due, r.first_due) == (None if r.schedule is None else False, 0, None), r.schedule


def test_masks(spark):
    one = spark.range(1).select(field_mask(F.lit("0,59"), 0, 59).alias("m"), cron_masks(F.lit("0 0 * * 7")).alias("w")).first()
    assert one.m == 1 | (1 << 59) and one.w.weekday == 1 and one.w.any_day and not one.w.any_weekday


def test_a_table_of_schedules_is_matched_without_a_shuffle(spark):
    rows = spark.range(1000).select("id", F.lit("* * * * *").alias("schedule"))
    plan = due(rows, *RANGES[0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    with pytest.raises(ValueError):
        due(rows, RANGES[0][1], RANGES[0][0])


def test_a_runner_runs_what_is_due(spark):
    pages = spark.createDataFrame([(0, '[{"a": 1}]')], "page bigint, body string")
    conn = write_pages(pages, scratch_dir(spark, "api"))
    plans = {"hourly": "0 * * * *", "at_noon": "0 12 * * *", "never": "0 0 30 2 *", "now": None}
    pipeline = PipelineSpec("p", [SourceSpec(n, "api", conn, s) for n, s in plans.items()])
    runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("p") + "_", audit_table=unique_name("runs"))
    ran = lambda *r: [x.source for x in runner.run_due(pipeline, *r)]
    day = dt.datetime(2024, 6, 1)
    assert ran(day.replace(hour=9, minute=30), day.replace(hour=10, minute=30)) == ["hourly"]
    assert ran(day.replace(hour=11, minute=59), day.replace(hour=12, minute=1)) == ["hourly", "at_noon"]
    assert ran(day.replace(minute=1), day.replace(minute=59)) == []


def test_minutes_are_counted_not_listed(spark):
    """Values and minutes of a field are bits: no expression lists them for each source."""
    big = ["0/9999 * * * *", "1-59/59 23 * * *", "59 0-23/23 1-31/30 1-12/11 0-7/7", "*/63,7 * * * *"]
    rows = spark.createDataFrame([(s,) for s in big], "schedule string")
    plan = due(rows, *RANGES[0])._jdf.queryExecution().analyzed().toString()
    assert "flatten" not in plan and all(f"sequence({lo}, {hi}" not in plan for _, lo, hi in FIELDS)
    got = {r.schedule: (r.n_due, r.first_due, r.last_due) for r in due(rows, dt.datetime(2024, 2, 27, 10), dt.datetime(2024, 3, 4, 6)).collect()}
    walk = [dt.datetime(2024, 2, 27, 10) + dt.timedelta(minutes=k) for k in range(8400)]
    walk = [t for t in walk if t < dt.datetime(2024, 3, 4, 6)]
    for s in big:
        hits = [t for t in walk if fits(s, t)]
        assert got[s] == (len(hits), hits[0] if hits else None, hits[-1] if hits else None), s
