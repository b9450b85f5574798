"""Large arrays in files: ranges and batches against json on the whole text."""

import io
import json
import os
import resource

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators import normalize
from tributary.session import local_path, scratch_dir
from tributary.sources import arrays
from tributary.sources.arrays import ArrayError, batches, read_large_arrays, summary

LEAF = st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.text(alphabet='ab"\\,[]{}:é日\n', max_size=8)
VALUE = st.recursive(LEAF, lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(alphabet='k"\\]', max_size=3), c, max_size=3), max_leaves=6)
OBJECT = st.dictionaries(st.text(alphabet='k"\\}', max_size=3), VALUE, max_size=3)


def in_ranges(raw, step, batch):
    """All bodies of a file, range by range, each begun by the sums of those before."""
    out, in_string, depth = [], False, 0
    for start in range(0, len(raw), step):
        stop = min(start + step, len(raw))
        out += batches(io.BytesIO(raw), len(raw), start, stop, in_string, depth, batch)
        quotes, outside, inside = summary(io.BytesIO(raw), start, stop)
        depth += inside if in_string else outside
        in_string ^= bool(quotes)
    return out


def items(bodies):
    return [x for _, b in sorted(bodies) for x in json.loads(b)]


@settings(max_examples=300, deadline=None)
@given(st.lists(OBJECT, max_size=6), st.integers(1, 40), st.integers(1, 30), st.sampled_from([None, 1]), st.booleans())
def test_objects_come_whole_and_in_order(values, step, batch, indent, ascii):
    raw = json.dumps(values, indent=indent, ensure_ascii=ascii).encode()
    assert items(in_ranges(raw, step, batch)) == values


@settings(max_examples=300, deadline=None)
@given(LEAF | st.lists(VALUE, max_size=2), st.lists(VALUE, max_size=6), st.integers(1, 40), st.integers(1, 30))
def test_other_items_are_wrapped(first, rest, step, batch):
    raw = (" \n" + json.dumps([first, *rest], indent=1) + " \n\t").encode()
    assert items(in_ranges(raw, step, batch)) == [{"value": v} for v in [first, *rest]]


@pytest.mark.parametrize("step", [1, 3, 1000])
@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_read_buffers_of_any_size(monkeypatch, step, chunk):
    monkeypatch.setattr(arrays, "READ_BYTES", chunk)
    values = [{"a": 'x\\"]}', "b": ["\\\\", {"c": '"'}]}] * 9
    raw = b"\xef\xbb\xbf " + json.dumps(values).encode()
    assert items(in_ranges(raw, step, 10)) == values


@pytest.mark.parametrize("raw", [b"[]", b" [ ] ", b"[\n]"])
@pytest.mark.parametrize("step", [1, 100])
def test_an_empty_array_is_one_empty_body(raw, step):
    assert [b for _, b in in_ranges(raw, step, 10)] == [b"[]"]


@pytest.mark.parametrize("raw", [b'{"a": [1, 2]}', b'"x, [y"', b"17", b" null "])
def test_other_values_are_one_body(raw):
    assert [json.loads(b) for _, b in in_ranges(raw, 3, 2)] == [json.loads(raw)]


BROKEN = [b'[{"a": 1}', b'[{"a": 1},', b"[", b'[{"a": 1}] x', b'[{"a": 1}]]', b"[1] [2]", b'[{"a": 1}, 5]', b"[{},]",
          b'[{"a": 1}}', b"[1,]", b"[1}", b'[{"a": "x]', "[1]".encode("utf-16")]


@pytest.mark.parametrize("raw", BROKEN)
@pytest.mark.parametrize("step", [1, 4, 100])
def test_broken_files_raise_or_give_bodies_that_do_not_parse(raw, step):
    """Whatever the ranges, some range objects, or some body is not JSON (the parser says so)."""
    with pytest.raises((ArrayError, json.JSONDecodeError)):
        for _, body in in_ranges(raw, step, 1):
            json.loads(body)


def _file(spark, raw, name="big.json"):
    folder = os.path.join(local_path(scratch_dir(spark, "arrays")), "ships")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as out:
        out.write(raw)
    return folder


def test_normalize_takes_the_batches_as_it_would_take_the_whole(spark):
    values = [{"first": i, "x": i / 4 if i % 3 else i, "late": None} for i in range(500)] + [{"other": 1, "first": 7}]
    folder = _file(spark, json.dumps(values, indent=2).encode())
    rows = read_large_arrays(spark, folder, range_bytes=1000, batch_bytes=300)
    assert rows.count() > 50 and rows.select("source").distinct().first().source == "ships"
    got = normalize(rows)
    whole = normalize(spark.createDataFrame([(0, json.dumps(values))], "seq bigint, body string"))
    assert got.schema == whole.schema and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_files_in_order_broken_ones_and_modes(spark):
    folder = _file(spark, b'[{"b": 1}, {"b": 2}]', "2.json")
    for name, raw in (("1.json", b'[{"a": 1, "b": 0}]'), ("3.json", b""), ("4.txt", b"[[")):
        with open(os.path.join(folder, name), "wb") as out:
            out.write(raw)
    got = normalize(read_large_arrays(spark, folder, range_bytes=7, batch_bytes=1))
    assert got.columns == ["a", "b"] and sorted(r.b for r in got.collect()) == [0, 1, 2]
    with open(os.path.join(folder, "5.json"), "wb") as out:
        out.write(b'[{"b": 3}, {"b": 4')
    with pytest.raises(Exception, match="not closed"):
        read_large_arrays(spark, folder).collect()
    rows = read_large_arrays(spark, folder, mode="PERMISSIVE", range_bytes=7, batch_bytes=1)
    assert rows.where("error is not null").count() >= 1
    assert sorted(r.b for r in normalize(rows, mode="PERMISSIVE").collect()) == [0, 1, 2, 3]


def test_a_workers_memory_does_not_depend_on_the_file(tmp_path):
    """60 MB in one array, cut in a process that may use little more than it has."""
    path = tmp_path / "big.json"
    item = json.dumps({"k": 1, "text": "x" * 200, "list": list(range(20))})
    with open(path, "w") as out:
        out.write("[")
        for i in range(200_000):
            out.write(("," if i else "") + item)
        out.write("]")
    size, before, n = path.stat().st_size, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0
    assert size > 55_000_000
    with open(path, "rb") as stream:
        for _, body in batches(stream, size, 0, size, False, 0):
            assert len(body) < arrays.BATCH_BYTES + 1000
            n += body.count(b'"k"')
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert n == 200_000 and grown < 220, f"{grown} MB"


def test_ranges_go_to_many_tasks(spark, tmp_path):
    """Ranges are short rows: partitions sized by their bytes would give one task all of a file."""
    from tributary.sources.arrays import parts_for_ranges

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text(json.dumps([{"a": i, "b": "x" * 40} for i in range(2000)]))
    got = read_large_arrays(spark, str(tmp_path / "a"), range_bytes=2000, batch_bytes=500)
    assert got.rdd.getNumPartitions() == min(4 * spark.sparkContext.defaultParallelism, 60) > 1
    assert sum(len(json.loads(r.body)) for r in got.collect()) == 2000
    assert (parts_for_ranges(spark, 0), parts_for_ranges(spark, 1), parts_for_ranges(spark, 10**6)) == (1, 1, 62500)


def test_few_bytes_are_read_behind_a_range():
    """A range reads to the end of its last item, not another read buffer."""
    raw = b"[" + b",".join(b'{"a": %d}' % i for i in range(200_000)) + b"]"
    read = []

    class Counted(io.BytesIO):
        def read(self, size=-1):
            got = super().read(size)
            read.append(len(got))
            return got

    list(batches(Counted(raw), len(raw), 0, 10_000, False, 0, 1000))
    assert sum(read) < 30_000


def test_the_first_body_is_kept_once_a_response(spark):
    """The aggregate that holds a body sees a row for each response, not for each item."""
    seen = []
    plain = F.min_by
    body = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.concat(F.lit('{"z":'), i.cast("string"), F.lit(',"a":1}'))), ","), F.lit("]"))
    rows = spark.range(4).select(F.col("id").alias("seq"), F.when(F.col("id") == 0, "[]").otherwise(body).alias("body"))
    try:
        F.min_by = lambda c, order: seen.append(order._jc.toString()) or plain(c, order)
        out = normalize(rows)
    finally:
        F.min_by = plain
    assert out.columns == ["z", "a"] and out.count() == 150
    assert any("size(recs)" in s for s in seen)
