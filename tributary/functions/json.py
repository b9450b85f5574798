"""Column helpers for JSON payloads held as VARIANT.

Emptiness tests are wrapped so that they never evaluate to SQL NULL (a NULL test
would silently drop a row inside ``filter``). Body-level truthiness is read from
the text: see ``tributary.operators.payload.text_has_data``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT_T = "map<string,variant>"
ARRAY_T = "array<variant>"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_body(body: Column | str) -> Column:
    """Text → VARIANT; unparsable text gives SQL NULL (a JSON ``null`` is a variant null)."""
    return F.try_parse_json(_c(body))


def wrapped_value(text: Column | str) -> Column:
    """The array ``[text, mark]`` as VARIANT, or NULL; see ``is_single`` and ``inner_value``.

    Spark's parsers stop after the first complete value. The mark is a hash of the text, so
    no text can bring its own: whatever stands behind the first value of ``text`` shows.
    """
    t = _c(text)
    return F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"'), F.xxhash64(t).cast("string"), F.lit('"]')))


def is_single(wrapped: Column, text: Column | str) -> Column:
    """Whether ``text`` was exactly one JSON value."""
    mark = F.xxhash64(_c(text)).cast("string")
    return F.coalesce((F.try_variant_get(wrapped, "$[1]", "string") == mark)
                      & F.try_variant_get(wrapped, "$[2]", "variant").isNull(), F.lit(False))


def inner_value(wrapped: Column) -> Column:
    return F.try_variant_get(wrapped, "$[0]", "variant")


def single_value(text: Column | str) -> Column:
    """Text → VARIANT if it is one JSON value and nothing else; otherwise NULL."""
    w = wrapped_value(text)
    return F.when(is_single(w, text), inner_value(w))


def as_object(v: Column | str) -> Column:
    """The top level of an object as ``map<string,variant>``; NULL for other kinds."""
    return _c(v).try_cast(OBJECT_T)


def as_array(v: Column | str) -> Column:
    """An array as ``array<variant>``; NULL for other kinds."""
    return _c(v).try_cast(ARRAY_T)


def is_empty_container(v: Column | str) -> Column:
    """True for ``{}`` and ``[]`` only (``[null]`` and nested empties are not empty)."""
    v = _c(v)
    return F.coalesce(F.size(as_object(v)) == 0, F.lit(False)) | F.coalesce(
        F.size(as_array(v)) == 0, F.lit(False)
    )


def variant_text(v: Column | str) -> Column:
    """JSON text of a variant (keys sorted, as VARIANT stores them)."""
    return F.to_json(_c(v))
