"""The ingest pipeline, the report and the job entry."""

from logmill.plans.pipeline import LogPipeline, pipeline
from logmill.plans.report import report, save_report

__all__ = ["LogPipeline", "pipeline", "report", "save_report"]
