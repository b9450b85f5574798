"""Pipelines: specs, config tables, the runner and its audit trail."""

from tributary.plans.configs import load_configs, pipeline_sources, read_pipeline_files, validate_sources
from tributary.plans.runner import AUDIT_SCHEMA, RunResult, Runner, job_summary, run_history
from tributary.plans.specs import PipelineSpec, SourceSpec, load_pipelines, source_errors

__all__ = [
    "AUDIT_SCHEMA",
    "PipelineSpec",
    "RunResult",
    "Runner",
    "SourceSpec",
    "job_summary",
    "load_configs",
    "load_pipelines",
    "pipeline_sources",
    "read_pipeline_files",
    "run_history",
    "source_errors",
    "validate_sources",
]
