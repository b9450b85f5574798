"""tributary — a Spark-native, configuration-driven ingestion engine.

Sources (JDBC, REST) are read as DataFrames, shaped with native expressions
(payload → records, empty-value cleaning, first-record or union schema with
checked type unification, generic names) and written to a raw JSON layer and a
typed catalog table (create / append / replace on schema change), with an audit
row per run. The raw layer can be loaded incrementally with Structured Streaming.

Entry points:

* ``tributary.plans``: ``PipelineSpec`` / ``SourceSpec`` / ``load_pipelines``,
  ``Runner`` (``run_pipeline``, ``run_source``, ``run_status``, ``run_history``),
  ``load_configs`` (validation of many pipeline files as a Spark job)
* ``tributary.sources``: ``JdbcSource``, ``RestSource`` (``rest_json`` data
  source), ``read_documents``, ``register_type``
* ``tributary.operators``: ``normalize`` and its parts, ``named_rows``,
  ``generic_columns``
* ``tributary.sinks``: ``write_raw`` / ``read_raw`` and variants, ``write_table``
* ``tributary.streaming``: ``incremental_load``, ``incremental_responses_load``
* ``python -m tributary run <folder>``: the command line
"""

__version__ = "0.1.0"
