"""Payload shaping: response bodies → one row per record (N3–N6, N9–N11).

Input is a table of responses, one JSON body per row, with an order given by
``seq``. Each body becomes zero or more records, each a VARIANT object:

* object body → that object is the one record;
* array body whose first item is an object → each item is a record (a later
  non-object item is an error);
* any other array → each item becomes ``{"value": item}``;
* any other value → ``{"value": body}``;
* bodies that are empty by Python truthiness (null, {}, [], "", 0, false) and
  unparsable bodies give no records.

Records then lose top-level keys whose value is ``{}`` or ``[]``; a record left
with no keys becomes ``{"placeholder": "empty_record"}``.

Everything is a narrow projection plus ``posexplode``: no shuffle, no UDF.
Kinds and emptiness come from the body text; the map form of a record (which
copies its values) is built only where cleaning may change it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed import PLACEHOLDER_KEY, PLACEHOLDER_VALUE, VALUE_KEY
from tributary.functions.json import as_object, inner_value, is_empty_container, is_single, wrapped_value


MODES = ("FAILFAST", "PERMISSIVE")


def _check_mode(mode: str) -> str:
    m = mode.upper()
    if m not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return m


# JSON text patterns (whitespace as JSON defines it). Kinds and emptiness are
# read from the body text, which is far cheaper than walking the parsed value;
# the parse (done once per body) still decides validity.
_WS = "[ \\t\\n\\r]*"
_FIRST = f"^{_WS}(.)"
# every JSON value that Python treats as false: {} [] "" null false 0 (any spelling)
_FALSY_TEXT = (f'^{_WS}(\\{{{_WS}\\}}|\\[{_WS}\\]|""|null|false'
               f'|-?0+(\\.0*)?([eE][+-]?[0-9]+)?){_WS}$')
_HAS_EMPTY = f"[\\[{{]{_WS}[\\]}}]"
_ARRAY_OF_OBJECTS = f"^{_WS}\\[{_WS}\\{{"


def text_has_data(body: Column) -> Column:
    """Python truthiness of a JSON text, from the text alone (NULL text → False)."""
    return F.coalesce(~body.rlike(_FALSY_TEXT), F.lit(False))


def classify_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``_v`` (variant), ``kind`` and ``has_data``.

    ``kind`` is ``invalid`` for unparsable text (or a set ``error`` column),
    else ``object``, ``array``, ``null``, ``boolean``, ``string`` or ``number``.
    Each body is parsed once; filter on ``has_data`` only after this point if
    the filter may be pushed below the parse (``response_records`` filters on
    the text instead).
    """
    text = F.col(body)
    # like Python's json, a text with anything after its value (``{"a":1} x``, ``[1] [2]``)
    # is not valid JSON; the one parse shows it
    df = responses.select("*", wrapped_value(text).alias("_w"), F.regexp_extract(text, _FIRST, 1).alias("_c"))
    df = df.select("*", inner_value(F.col("_w")).alias("_v"), is_single(F.col("_w"), text).alias("_single"))
    c = F.col("_c")
    kind = (F.when(F.col("_v").isNull() | ~F.col("_single"), F.lit("invalid"))
            .when(c == "{", F.lit("object")).when(c == "[", F.lit("array"))
            .when(c == "n", F.lit("null")).when(c.isin("t", "f"), F.lit("boolean"))
            .when(c == '"', F.lit("string")).otherwise(F.lit("number")))
    if "error" in responses.columns:
        kind = F.when(F.col("error").isNotNull(), F.lit("invalid")).otherwise(kind)
    df = df.select(*responses.columns, "_v", kind.alias("kind"))
    return df.withColumn("has_data", (F.col("kind") != "invalid") & text_has_data(text))


def clean_record(rec: Column) -> Column:
    """``map<string,variant>`` record: drops top-level ``{}``/``[]`` values; an
    emptied record becomes the placeholder."""
    kept = F.map_filter(rec, lambda _k, x: ~is_empty_container(x))
    placeholder = F.create_map(
        F.lit(PLACEHOLDER_KEY), F.parse_json(F.lit(f'"{PLACEHOLDER_VALUE}"'))
    )
    return F.when(rec.isNull(), rec).when(F.size(kept) == 0, placeholder).otherwise(kept)


def _placeholder_variant() -> Column:
    return F.parse_json(F.lit(f'{{"{PLACEHOLDER_KEY}":"{PLACEHOLDER_VALUE}"}}'))


def body_records(classified: DataFrame, body: str = "body", clean: bool = True,
                 mode: str = "FAILFAST") -> tuple[Column, Column]:
    """(``recs``, ``wrapped``) of one classified response.

    ``recs`` is ``array<variant>`` of object records. The map route, which
    copies values, runs only for bodies whose text holds an empty ``{}``/``[]``;
    a non-object item after a leading object fails there (FAILFAST) or becomes
    NULL, and elsewhere is rejected by the schema pass. An invalid response
    has no records (FAILFAST raises).
    """
    v, kind, text = F.col("_v"), F.col("kind"), F.col(body)
    objects = (kind == "object") | ((kind == "array") & text.rlike(_ARRAY_OF_OBJECTS))
    items = F.when(kind == "array", v.try_cast("array<variant>")).otherwise(F.array(v))
    wrap = lambda x: F.to_variant_object(F.create_map(F.lit(VALUE_KEY), x))
    not_object = F.raise_error(F.concat(
        F.lit("response seq "), F.col("seq").cast("string"),
        F.lit(" mixes objects with non-object items"))).cast("variant")
    if clean:
        def cleaned(x):
            rec = F.to_variant_object(clean_record(as_object(x)))
            if mode == "FAILFAST":
                return F.when(as_object(x).isNull(), not_object).otherwise(rec)
            return rec
        obj_recs = F.when(text.rlike(_HAS_EMPTY), F.transform(items, cleaned)).otherwise(items)
        wrapped_recs = F.transform(items, lambda x: F.when(is_empty_container(x), _placeholder_variant())
                                   .otherwise(wrap(x)))
    else:
        obj_recs, wrapped_recs = items, F.transform(items, wrap)
    invalid = F.array().cast("array<variant>")
    if mode == "FAILFAST":
        invalid = F.raise_error(F.concat(
            F.lit("invalid response (seq "), F.col("seq").cast("string"),
            F.lit("): body is not JSON or the fetch failed"))).cast("array<variant>")
    recs = F.when(kind == "invalid", invalid).when(objects, obj_recs).otherwise(wrapped_recs)
    return recs, ~objects


def response_records(responses: DataFrame, *, body: str = "body", mode: str = "FAILFAST",
                     clean: bool = True, keep: tuple[str, ...] = ("source", "load_id", "seq"),
                     keep_body: bool = False) -> DataFrame:
    """Responses → record arrays, one row per response whose text has data.

    Output columns: the ``keep`` columns that exist, ``wrapped`` (records are
    ``{"value": …}`` wrappers), ``recs`` (``array<variant>``; empty for an
    invalid response in PERMISSIVE mode) and, with ``keep_body``, ``_body``.
    """
    mode = _check_mode(mode)
    text = F.col(body)
    failed = F.col("error").isNotNull() if "error" in responses.columns else F.lit(False)
    if mode == "FAILFAST":  # failed fetches carry no body: do not let the text filter hide them
        df = responses.filter(text_has_data(text) | failed | text.isNull())
    else:
        df = responses.filter(text_has_data(text) & ~failed)
    df = classify_responses(df, body)
    recs, wrapped = body_records(df, body, clean, mode)
    cols = [c for c in keep if c in responses.columns]
    out = [F.col(c) for c in cols] + [wrapped.alias("wrapped"), recs.alias("recs")]
    if keep_body:
        out.append(F.col(body).alias("_body"))
    return df.select(*out)


def first_keys(rec: Column, body: Column, wrapped: Column) -> Column:
    """Column names a record gives when it is the first one of the table, in the
    order its body text lists them (VARIANT itself keeps keys sorted)."""
    raw = F.coalesce(F.json_object_keys(body), F.json_object_keys(F.get_json_object(body, "$[0]")))
    kept = F.map_keys(as_object(rec))
    inter = F.array_intersect(raw, kept)
    cleaned = F.when(F.coalesce(F.size(inter), F.lit(0)) > 0, inter).otherwise(kept)
    return (F.when(wrapped, kept)
            .when(body.rlike(_HAS_EMPTY), cleaned)
            .otherwise(F.coalesce(F.array_distinct(raw), kept)))


def keys_of_first(spark, body: str, mode: str, clean: bool = True) -> list[str]:
    """``first_keys`` of the one response whose first record decides the columns."""
    one = spark.createDataFrame([(0, body)], "seq bigint, body string")
    recs = response_records(one, mode=mode, clean=clean, keep=("seq",), keep_body=True)
    row = recs.select(first_keys(F.col("recs")[0], F.col("_body"), F.col("wrapped")).alias("keys")).first()
    return list(row["keys"] or []) if row is not None else []


def explode_records(recs: DataFrame, keep: tuple[str, ...] = ("source", "load_id", "seq")) -> DataFrame:
    """One row per record: the ``keep`` columns, ``wrapped``, ``pos``, ``rec`` and,
    when the input has ``_body``, ``_body0`` — the body text, on position 0 only."""
    cols = [c for c in keep if c in recs.columns]
    if "_body" in recs.columns:
        tagged = F.transform("recs", lambda x, i: F.struct(
            x.alias("rec"), F.when(i == 0, F.col("_body")).alias("_body0")))
        return recs.select(*cols, "wrapped", F.posexplode(tagged).alias("pos", "_t")).select(
            *cols, "wrapped", "pos", F.col("_t.rec").alias("rec"), F.col("_t._body0").alias("_body0"))
    return recs.select(*cols, "wrapped", F.posexplode("recs").alias("pos", "rec"))


def skip_empty(responses: DataFrame, body: str = "body") -> DataFrame:
    """Responses whose body has data (N11); unparsable and failed ones are dropped."""
    df = classify_responses(responses.filter(text_has_data(F.col(body))), body)
    return df.filter(F.col("kind") != "invalid").select(*responses.columns)


def response_outcomes(responses: DataFrame, body: str = "body") -> DataFrame:
    """Per response: ``outcome`` in (``failed``, ``invalid_json``, ``empty``, ``ok``)."""
    df = classify_responses(responses, body)
    has_error = F.col("error").isNotNull() if "error" in responses.columns else F.lit(False)
    outcome = (
        F.when(has_error, F.lit("failed"))
        .when(F.col("kind") == "invalid", F.lit("invalid_json"))
        .when(~F.col("has_data"), F.lit("empty"))
        .otherwise(F.lit("ok"))
    )
    return df.select(*responses.columns, outcome.alias("outcome"))
