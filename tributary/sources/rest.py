"""REST source (S7–S11): a Spark Python data source named ``rest_json``.

Requests are split into input partitions (``requests_per_partition`` each,
default 1), so they run on the executors in parallel and nothing is fetched on
the driver. Each request yields one response row::

    source STRING, load_id STRING, seq BIGINT, url STRING, status INT,
    fetched_at TIMESTAMP, body STRING, error STRING

Options:

``endpoint``   URL (required)
``method``     ``GET`` (default) or ``POST``, case-insensitive
``args``       JSON object of query parameters (GET); a list repeats its key, null is left out
``body``       JSON payload (POST)
``requests``   JSON array of ``{"args": …, "body": …}``; a connection's ``requests_table``
               names a table of them instead (``tributary.sources.requests``)
``page_param`` with ``pages``: GET the same endpoint ``pages`` times with
               ``page_param`` = ``page_start`` … (an extension: pagination); an
               endpoint containing ``{page}`` gets the number in its path instead
``requests_per_partition``  requests fetched by one task (default 1)
``partitions`` target number of tasks instead (requests spread evenly); the
               connector's ``"auto"`` means twice the default parallelism; a
               ``max_partitions`` of the connection limits that, for an endpoint
               that bears no more
``pages_endpoint``, ``pages_key``  for streams: where the number of pages stands
``timeout``    seconds per request (default 30)
``mode``       ``FAILFAST`` (default): a failed request fails the task (Spark
               retries it); ``PERMISSIVE``: the row carries ``error`` and a NULL body
``source`` / ``load_id``  copied into every row
``fetcher``    ``module:function`` replacing the HTTP call, for tests; called as
               ``fn(method, url, params, body, timeout) -> (status, text)``

Only the transport is Python; parsing and shaping happen afterwards in native
expressions (``tributary.operators.normalize``).
"""

from __future__ import annotations

import datetime as _dt
import importlib
import json
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RESPONSE_SCHEMA = (
    "source string, load_id string, seq bigint, url string, status int, "
    "fetched_at timestamp, body string, error string"
)
RESPONSE_COLUMNS = [field.split()[0] for field in RESPONSE_SCHEMA.split(", ")]
METHODS = ("GET", "POST")


def response_struct():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(RESPONSE_SCHEMA)


@dataclass
class Request:
    seq: int
    method: str
    url: str
    params: dict
    body: Any


@dataclass
class RequestPartition(InputPartition):
    start: int
    stop: int


def with_query(url: str, params: dict) -> str:
    """``url`` with query parameters: a list repeats its key, null values are left out."""
    pairs = [(k, x) for k, v in params.items()
             for x in (v if isinstance(v, (list, tuple)) else [v]) if x is not None]
    if not pairs:
        return url
    return url + ("&" if "?" in url else "?") + urllib.parse.urlencode(pairs)


def http_fetch(method: str, url: str, params: dict, body: Any, timeout: float) -> tuple[int, str]:
    """Plain urllib transport: GET with query parameters, POST with a JSON payload."""
    if method == "GET":
        req = urllib.request.Request(with_query(url, params), method="GET")
    else:
        data = json.dumps(body if body is not None else {}).encode()
        req = urllib.request.Request(url, data=data, method="POST",
                                     headers={"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(req, timeout=timeout) as resp:  # noqa: S310
            text = decode_body(resp.read(), resp.headers.get_content_charset())
            return resp.status or 200, text  # file:// has no status
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def decode_body(raw: bytes, charset: str | None = None) -> str:
    """A JSON body's text: a byte order mark or the zero bytes of its first characters tell
    UTF-8, 16 and 32 apart; a charset that the response names is used where they do not
    speak against it. The mark itself is dropped."""
    found = json.detect_encoding(raw)
    return raw.decode(found if found != "utf-8" or not charset else charset)


def _load_fetcher(spec: str | None):
    if not spec:
        return http_fetch
    module, _, fn = spec.partition(":")
    return getattr(importlib.import_module(module), fn)


def _json_option(options: dict, key: str, default: Any) -> Any:
    raw = options.get(key)
    if raw is None or raw == "":
        return default
    try:
        return json.loads(raw)
    except json.JSONDecodeError as e:
        raise ValueError(f"option {key!r} is not JSON: {e}") from e


class RequestPlan:
    """The requests of one read, numbered from 0; each is made when its task asks for it.

    Options are checked here, on the driver. Nothing is listed: a plan of a million
    pages is as small as a plan of one.
    """

    def __init__(self, options: dict) -> None:
        self.endpoint = options.get("endpoint")
        if not self.endpoint:
            raise ValueError("rest_json: option 'endpoint' is required")
        self.method = str(options.get("method", "GET")).upper()
        if self.method not in METHODS:
            raise ValueError(f"rest_json: unsupported method {self.method!r}; use one of {METHODS}")
        self.args = _json_option(options, "args", {})
        self.body = _json_option(options, "body", {})
        if not isinstance(self.args, dict):
            raise ValueError("rest_json: option 'args' must be a JSON object")
        self.explicit = _json_option(options, "requests", None)
        self.page_param = options.get("page_param")
        self.page_start = int(options.get("page_start", 1))
        if self.explicit is not None:
            if not isinstance(self.explicit, list) or not all(isinstance(r, dict) for r in self.explicit):
                raise ValueError("rest_json: option 'requests' must be a JSON array of objects")
            self.count = len(self.explicit)
        elif self.page_param or "{page}" in self.endpoint:
            self.count = int(options.get("pages", 1))
        else:
            self.count = 1

    def request(self, i: int) -> Request:
        if self.explicit is not None:
            own = self.explicit[i]
            return Request(i, self.method, self.endpoint, {**self.args, **(own.get("args") or {})},
                           own.get("body", self.body))
        if "{page}" in self.endpoint:
            return Request(i, self.method, self.endpoint.replace("{page}", str(self.page_start + i)),
                           self.args, self.body)
        paged = {self.page_param: self.page_start + i} if self.page_param else {}
        return Request(i, self.method, self.endpoint, {**self.args, **paged}, self.body)


def request_mode(options: dict) -> str:
    mode = str(options.get("mode", "FAILFAST")).upper()
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"rest_json: mode must be FAILFAST or PERMISSIVE, got {mode!r}")
    return mode


def send(fetch, options: dict, request: Request) -> tuple:
    """One request → one response row."""
    shown = with_query(request.url, request.params) if request.method == "GET" else request.url
    status, text, error = None, None, None
    try:
        status, text = fetch(request.method, request.url, request.params, request.body,
                             float(options.get("timeout", 30)))
        if status is not None and status >= 400:
            error = f"HTTP {status}"
    except Exception as e:  # transport failure
        error = f"{type(e).__name__}: {e}"
    if error is not None:
        if request_mode(options) == "FAILFAST":
            raise RuntimeError(f"rest_json request {request.seq} to {shown} failed: {error}")
        text = None
    return (options.get("source"), options.get("load_id"), request.seq, shown, status,
            _dt.datetime.now(_dt.timezone.utc), text, error)


def _ranges(options: dict, start: int, stop: int) -> list[RequestPartition]:
    """The requests from start to stop, dealt to tasks."""
    n = max(1, int(options.get("requests_per_partition", 1)))
    if options.get("partitions"):
        n = max(1, -(-(stop - start) // max(1, int(options["partitions"]))))
    return [RequestPartition(i, min(i + n, stop)) for i in range(start, stop, n)]


#: A worker hands over its responses after so many of them, or so many characters.
ROWS_OUT, CHARS_OUT = 256, 4 << 20


def response_batch(rows: list[tuple]):
    """Response rows as the Arrow batch that leaves a worker."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
        pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.timestamp("us", "UTC"), pa.string(), pa.string()))], RESPONSE_COLUMNS)


def _read(options: dict, partition: RequestPartition):
    """Arrow batches of a few responses: rows would be held until there are thousands of them."""
    fetch, plan = _load_fetcher(options.get("fetcher")), RequestPlan(options)
    waiting, chars = [], 0
    for i in range(partition.start, partition.stop):
        waiting.append(send(fetch, options, plan.request(i)))
        chars += len(waiting[-1][6] or "")
        if len(waiting) >= ROWS_OUT or chars >= CHARS_OUT:
            yield response_batch(waiting)
            waiting, chars = [], 0
    if waiting:
        yield response_batch(waiting)


class RestJsonReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)
        request_mode(self.options)
        RequestPlan(self.options)  # fail early

    def partitions(self):
        return _ranges(self.options, 0, RequestPlan(self.options).count)

    def read(self, partition: RequestPartition):
        return _read(self.options, partition)


class RestJsonStreamReader(DataSourceStreamReader):
    """The pages of an endpoint as a stream: the offset is the number of pages taken.

    ``pages_endpoint`` answers with the number of pages there are (a number, or an object
    that has it under ``pages_key``), so a run without new pages fetches none. Pages are
    numbered as in batch reads, and only ever added: fewer pages than were taken raise.
    """

    def __init__(self, options: dict) -> None:
        self.options = dict(options)
        request_mode(self.options)
        plan = RequestPlan(self.options)
        if plan.explicit is not None or not (plan.page_param or "{page}" in plan.endpoint):
            raise ValueError("rest_json: a stream needs pages: {page} in the endpoint, or 'page_param'")
        if not self.options.get("pages_endpoint"):
            raise ValueError("rest_json: a stream needs 'pages_endpoint', which tells how many pages there are")

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        fetch = _load_fetcher(self.options.get("fetcher"))
        status, text = fetch("GET", self.options["pages_endpoint"], {}, None, float(self.options.get("timeout", 30)))
        if status is not None and status >= 400:
            raise RuntimeError(f"rest_json: {self.options['pages_endpoint']} answers HTTP {status}")
        found = json.loads(text)
        if self.options.get("pages_key"):
            found = found[self.options["pages_key"]]
        if isinstance(found, bool) or not isinstance(found, int) or found < 0:
            raise ValueError(f"rest_json: {self.options['pages_endpoint']} gives no number of pages: {text[:200]!r}")
        return {"pages": found}

    def partitions(self, start: dict, end: dict):
        if end["pages"] < start["pages"]:
            raise RuntimeError(f"rest_json: {start['pages']} pages were taken, and now there are only {end['pages']}")
        return _ranges(self.options, start["pages"], end["pages"])

    def read(self, partition: RequestPartition):
        return _read(self.options, partition)

    def commit(self, end: dict) -> None:
        """Nothing to keep: Spark's checkpoint holds the offsets."""


class RestJsonDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_json"

    def schema(self) -> str:
        return RESPONSE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RestJsonReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RestJsonStreamReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(RestJsonDataSource)


class RestSource:
    """Source spec → response DataFrame through the ``rest_json`` data source."""

    type_name = "api"

    def __init__(self, spec) -> None:
        self.spec = spec
        self.conn = dict(spec.connection)

    def options(self, load_id: str | None = None) -> dict[str, str]:
        c = self.conn
        opts = {"endpoint": c.get("endpoint") or "", "method": str(c.get("type", "GET")),
                "source": self.spec.name}
        if load_id:
            opts["load_id"] = load_id
        if "args" in c:
            opts["args"] = json.dumps(c["args"])
        if "body" in c:
            opts["body"] = json.dumps(c["body"])
        for key in ("requests",):
            if key in c:
                opts[key] = json.dumps(c[key])
        for key in ("page_param", "pages", "page_start", "timeout", "mode", "fetcher",
                    "requests_per_partition", "partitions", "pages_endpoint", "pages_key"):
            if key in c:
                opts[key] = str(c[key])
        return opts

    def _ready(self, spark, load_id: str | None) -> dict[str, str]:
        """The options with the number of tasks worked out, and what the workers need in place."""
        from tributary.session import ship_package

        ship_package(spark)  # the reader runs in Python workers: they import this module
        register(spark)
        opts = self.options(load_id)
        if opts.get("partitions") == "auto":
            tasks = 2 * spark.sparkContext.defaultParallelism
            if self.conn.get("max_partitions"):
                tasks = min(tasks, int(self.conn["max_partitions"]))
            opts["partitions"] = str(max(1, tasks))
        RequestPlan(opts)  # fail early, on the driver
        return opts

    def plan(self, spark, load_id: str | None = None):
        """This source's requests as a table."""
        from tributary.sources.requests import request_plan

        table = self.conn.get("requests_table")
        return request_plan(spark, self.options(load_id), spark.table(table) if table else None)

    def fetch(self, spark, plan, load_id: str | None = None):
        """The responses to the requests of ``plan``, dealt to tasks as a read would deal them."""
        from tributary.sources.requests import fetch_requests

        opts = self._ready(spark, load_id)
        if opts.get("partitions"):
            plan = plan.repartition(int(opts["partitions"]), "seq")
        return fetch_requests(plan, opts)

    def read(self, spark, load_id: str | None = None):
        if self.conn.get("requests_table"):
            return self.fetch(spark, self.plan(spark, load_id), load_id)
        return spark.read.format("rest_json").options(**self._ready(spark, load_id)).load()

    def read_stream(self, spark):
        """Pages that were added since the last run (see ``RestJsonStreamReader``)."""
        return spark.readStream.format("rest_json").options(**self._ready(spark, None)).load()
