"""Raw documents, one per fetch."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tributary.operators import normalize
from tributary.session import local_path, scratch_dir
from tributary.sinks.documents import write_documents
from tributary.sinks.raw import raw_path
from tributary.sources.documents import read_documents

SCHEMA = "seq bigint, body string, error string"


def files(root, source):
    folder = local_path(raw_path(root, source))
    return {n: open(os.path.join(folder, n)).read() for n in sorted(os.listdir(folder))} if os.path.isdir(folder) else {}


def test_one_response_is_one_indented_document_with_the_stamp(spark):
    root = scratch_dir(spark, "raw")
    body = '{"b": [1, {"c": "é"}], "a": null}'
    assert write_documents(spark.createDataFrame([(0, body, None)], SCHEMA), root, "ships", "20240102_030405") == "20240102_030405"
    assert files(root, "ships") == {"ships_20240102_030405.json": json.dumps(json.loads(body), indent=2)}
    got = read_documents(spark, raw_path(root, "ships")).first()
    assert (got.source, got.load_id) == ("ships", "20240102_030405") and json.loads(got.body) == json.loads(body)


def test_several_responses_have_their_numbers_and_failed_ones_leave_nothing(spark):
    root = scratch_dir(spark, "raw")
    rows = [(3, '[{"k": 3}]', None), (1, None, "HTTP 503"), (20, '[{"k": 20}]', None), (2, None, None)]
    write_documents(spark.createDataFrame(rows, SCHEMA).repartition(4), root, "s", "20240102_030405")
    assert sorted(files(root, "s")) == ["s_20240102_030405-20.json", "s_20240102_030405-3.json"]
    docs = read_documents(spark, raw_path(root, "s"))
    assert sorted((r.seq, r.load_id) for r in docs.collect()) == [(3, "20240102_030405"), (20, "20240102_030405")]
    assert [r.k for r in normalize(docs, keep=("seq",)).orderBy("seq").collect()] == [3, 20]


@pytest.mark.parametrize("bad", [(5, "{oops", None), (3, "[1]", None), (None, "[1]", None), (-1, "[1]", None)])
def test_a_failed_job_leaves_no_file(spark, bad):
    """A body that is not JSON, a repeated number and a missing one: nothing of the whole job stays."""
    root = scratch_dir(spark, "raw")
    rows = spark.createDataFrame([(3, "[1]", None), (4, "[2]", None), bad], SCHEMA).repartition(3)
    with pytest.raises(Exception):
        write_documents(rows, root, "s", "20240102_030405")
    assert files(root, "s") == {}


def test_no_responses_and_a_stamp_of_its_own(spark):
    root = scratch_dir(spark, "raw")
    stamp = write_documents(spark.createDataFrame([], SCHEMA), root, "s")
    assert len(stamp) == 15 and files(root, "s") == {}
    plain = spark.range(2).select(F.col("id").alias("seq"), F.lit("[]").alias("body"))
    write_documents(plain, root, "s", stamp)
    assert sorted(files(root, "s")) == [f"s_{stamp}-0.json", f"s_{stamp}-1.json"]
