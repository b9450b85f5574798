"""Streaming: incremental loading of the raw layer, and of pages as an endpoint gets them."""

from tributary.streaming.incremental import (
    LOAD_COL,
    incremental_fetch,
    incremental_load,
    incremental_responses_load,
)

__all__ = ["LOAD_COL", "incremental_fetch", "incremental_load", "incremental_responses_load"]
