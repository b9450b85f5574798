"""Responses that come again in a stream."""

import os

from pyspark.sql import functions as F

from tributary.session import local_path, scratch_dir, unique_name
from tributary.sinks.raw import raw_path, write_raw_responses
from tributary.streaming import incremental_responses_load

SCHEMA = "source string, seq bigint, url string, fetched_at string, body string, error string"


def test_repeats_within_the_interval_go_and_state_is_dropped(spark):
    root, name = scratch_dir(spark, "s"), unique_name("t")

    def load(load_id, *rows):
        df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
        write_raw_responses(df, root, "s", load_id)
        out = incremental_responses_load(spark, raw_path(root, "s"), name, checkpoint=f"{root}/_c", table_path=f"{root}/tables/{name}",
                                         unique_within="1 hour")
        return out["rows"], out["late"]

    a = ("s", 0, "/0", "2024-01-01 00:00:00", '[{"k": 1}]')
    b = ("s", 1, "/1", "2024-01-01 00:00:00", '[{"k": 1}]')      # the same content of another page
    assert load("a", a, b, a) == (2, 0)                           # twice in one batch
    again = ("s", 0, "/0", "2024-01-01 00:30:00", '[{"k": 1}]')
    changed = ("s", 0, "/0", "2024-01-01 00:40:00", '[{"k": 2}]')
    assert load("b", again, changed) == (1, 0)                    # in another batch; and other content
    assert load("c", ("s", 5, "/5", "2024-01-02 00:00:00", '[{"k": 5}]')) == (1, 0)
    assert load("d", ("s", 0, "/0", "2024-01-02 00:10:00", '[{"k": 1}]')) == (1, 0)  # behind the interval: a new fetch
    assert load("e", ("s", 6, "/6", "2024-01-01 12:00:00", '[{"k": 6}]')) == (0, 1)  # late: left out and counted
    assert sorted(r.k for r in spark.table(name).collect()) == [1, 1, 1, 2, 5]
    assert os.path.isdir(local_path(f"{root}/_c/state"))
