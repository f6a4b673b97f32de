"""The report over the warehouse table."""

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from logmill.functions.scratch import materialize
from logmill.operators import traffic
from logmill.operators.moving_average import moving_avg_per_record
from logmill.sources.run_table import RunTable
from logmill.sources.text import read_rejects
from logmill.sources.warehouse import describe


class Report(Mapping):
    """Outputs by name, each built when it is asked for the first time."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def report(spark: SparkSession, errors_location: str, table: str = "joined_log_table") -> Report:
    """The outputs of the dashboard and the notebook, by name.

    Totals share one pass over the table: it is reduced to its few cells per
    status, method and hour first, and those are stored. A table that grows by runs
    has its cells and largest requests already; these outputs then read them only. Each output runs only
    the jobs that it needs, and only when it is asked for. ``errors_location`` is a
    folder of rejected lines or a lake.
    """
    log = cache(lambda: spark.table(table))
    kept, tops = cache(lambda: RunTable(spark, table).cells()), cache(lambda: RunTable(spark, table).tops())
    cells = cache(lambda: materialize(traffic.traffic_cells(log()), "cells")[0] if kept() is None else kept())

    def errors() -> DataFrame:
        return traffic.total_records(read_rejects(spark, errors_location)).withColumnRenamed("total_records", "total_errors")

    return Report(
        {
            "describe": lambda: describe(spark, table),
            "total_records": lambda: traffic.records_from_cells(cells()),
            "total_errors": errors,
            "total_mb": lambda: traffic.mb_from_cells(cells()),
            "mb_by_hour": lambda: traffic.mb_by_hour_from_cells(cells()),
            "mb_by_status": lambda: traffic.mb_by_from_cells(cells(), "status"),
            "mb_by_method": lambda: traffic.mb_by_from_cells(cells(), "method"),
            "top_bytes_by_hour": lambda: traffic.top_bytes_by_hour(log()) if tops() is None else traffic.top_from_tops(tops()),
            "moving_avg": lambda: moving_avg_per_record(log()),
        }
    )


def save_report(outputs: Mapping[str, DataFrame], path: str) -> None:
    """Write each output as a Parquet folder of its name."""
    for name, output in outputs.items():
        output.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
