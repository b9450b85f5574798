"""Requests as a table, and fetching them.

``request_plan`` gives the requests of a connection as rows (``seq, method, url, params,
body``): the pages of an endpoint come from a range, explicit requests from the connection,
and those of a table (``requests_table``) are never listed on the driver. ``fetch_requests``
sends the rows of such a table from the tasks that hold them, so a plan can be filtered,
joined with what was fetched before, or made by any query.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.sources.rest import (
    RESPONSE_COLUMNS,
    RESPONSE_SCHEMA,
    Request,
    RequestPlan,
    _load_fetcher,
    request_mode,
    send,
)

#: ``params`` and ``body`` are JSON text; null stands for none, and for the options' body.
PLAN_SCHEMA = "seq bigint, method string, url string, params string, body string"
#: A worker hands over its responses after so many of them, or so many characters.
ROWS_OUT, CHARS_OUT = 256, 8 << 20


def request_plan(spark: SparkSession, options: dict, requests: DataFrame | None = None) -> DataFrame:
    """The requests of ``rest_json`` options as rows, numbered by ``seq``.

    ``requests`` (a column ``seq`` and, as wanted, ``args`` and ``body``: JSON text, a struct,
    a map or a VARIANT) makes one request of each row; its args go over those of the
    options. A null ``seq`` raises.
    """
    plan = RequestPlan(options)
    if requests is not None:
        if "seq" not in requests.columns:
            raise ValueError("a table of requests needs a column 'seq'")
        if "{page}" in plan.endpoint:
            raise ValueError("an endpoint with {page} and a table of requests exclude each other")
        seq = F.col("seq").cast("bigint")
        numbered = F.when(seq.isNull(), F.raise_error(F.lit("a request has no seq")).cast("bigint")).otherwise(seq)
        return requests.select(numbered.alias("seq"), F.lit(plan.method).alias("method"), F.lit(plan.endpoint).alias("url"),
                               _json_text(requests, "args").alias("params"), _json_text(requests, "body").alias("body"))
    if plan.explicit is not None:
        rows = [(i, plan.method, plan.endpoint, json.dumps(own["args"]) if own.get("args") else None,
                 json.dumps(own["body"]) if "body" in own else None) for i, own in enumerate(plan.explicit)]
        return spark.createDataFrame(rows, PLAN_SCHEMA)
    page = (F.col("id") + plan.page_start).cast("string")
    url, params = F.lit(plan.endpoint), F.lit(None).cast("string")
    if "{page}" in plan.endpoint:
        url = F.replace(url, F.lit("{page}"), page)
    elif plan.page_param:
        params = F.concat(F.lit("{" + json.dumps(plan.page_param) + ": "), page, F.lit("}"))
    return spark.range(plan.count).select(F.col("id").alias("seq"), F.lit(plan.method).alias("method"), url.alias("url"),
                                          params.alias("params"), F.lit(None).cast("string").alias("body"))


def _json_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else F.to_json(F.col(name))


def fetch_requests(plan: DataFrame, options: dict) -> DataFrame:
    """Sends the requests of a plan, each once, from the task that holds it → response rows.

    Options as for ``rest_json``. Workers hand responses over in small batches, so a task
    of many requests holds few of them. FAILFAST raises on a failed request, PERMISSIVE
    gives a row with its error.
    """
    from tributary.session import ship_package

    ship_package(plan.sparkSession)
    opts = dict(options)
    request_mode(opts)
    base = RequestPlan(opts)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch, waiting, chars = _load_fetcher(opts.get("fetcher")), [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                own = json.loads(row.params) if row.params is not None else {}
                body = json.loads(row.body) if row.body is not None else base.body
                waiting.append(send(fetch, opts, Request(int(row.seq), row.method, row.url, {**base.args, **own}, body)))
                chars += len(waiting[-1][6] or "")
                if len(waiting) >= ROWS_OUT or chars >= CHARS_OUT:
                    yield response_frame(waiting)
                    waiting, chars = [], 0
        if waiting:
            yield response_frame(waiting)

    return plan.select("seq", "method", "url", "params", "body").mapInPandas(run, RESPONSE_SCHEMA)


def response_frame(rows: list[tuple]) -> pd.DataFrame:
    """Response rows as the frame that leaves a worker."""
    out = pd.DataFrame(rows, columns=RESPONSE_COLUMNS)
    out["status"] = out["status"].astype("Int32")
    out["fetched_at"] = pd.to_datetime(out["fetched_at"], utc=True)
    return out


_GOOD = ("ok", "empty")


def settled(responses: DataFrame) -> DataFrame:
    """A load's responses after repairs: the good ones, and the latest of a request that has only bad ones.

    A response whose body is not one JSON value is bad.
    """
    from tributary.operators.payload import response_outcomes

    judged = response_outcomes(responses)
    good = judged.where(F.col("outcome").isin(*_GOOD)).select(*responses.columns)
    bad = judged.where(~F.col("outcome").isin(*_GOOD)).join(good.select("seq").distinct(), "seq", "left_anti")
    last = bad.groupBy("seq").agg(F.max_by(F.struct(*responses.columns), F.col("fetched_at")).alias("r")).select("r.*")
    return good.unionByName(last)


def missing_requests(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """The requests of a plan that no good response answers: failed ones, and those never sent.

    A response whose body is not one JSON value counts as failed.
    """
    from tributary.operators.payload import response_outcomes

    good = response_outcomes(responses).where(F.col("outcome").isin(*_GOOD)).select("seq").distinct()
    return plan.join(good, "seq", "left_anti")
