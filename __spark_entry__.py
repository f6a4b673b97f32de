"""Entry points for the driver: a smoke query, all queries, and their SQL twins."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import standin
from logmill.functions import hour_of_day
from logmill.functions.scratch import scratch_path
from logmill.functions.sql import register
from logmill.operators import traffic
from logmill.operators.clean import clean, map_column
from logmill.operators.enrich import join_hostnames
from logmill.operators.moving_average import moving_avg_per_record
from logmill.operators.parse import parse, rejects
from logmill.plans import pipeline, report
from logmill.schema import FIELDS
from logmill.sources import lake, text, warehouse
from logmill.sources.host_buckets import HostBuckets
from logmill.sources.runs import RUN, Runs

try:  # the folder of these operators may be absent
    import corpus_pipeline
    from logmill.llm import queries as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "logmill.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The whole pipeline from log files to the warehouse table, then the largest request per hour."""
    return traffic.top_bytes_by_hour(_run_pipeline(spark, "/root/testdata/sf0.001"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.conform(clean(parse(standin.log_lines(spark, sf_dir))))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_hostnames(_cleaned(spark, sf_dir), standin.hostnames(spark, sf_dir))


def _on_joined(report: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: report(_joined(spark, sf_dir), *args)


def _write_log_files(spark: SparkSession, sf_dir: str) -> str:
    """Plain lines at one depth and packed lines at another, below a new folder."""
    root = scratch_path(spark, "logs")
    lines = standin.log_lines(spark, sf_dir)
    packed = F.col("value").contains("/signup/")
    lines.filter(~packed).write.text(f"{root}/web")
    lines.filter(packed).write.text(f"{root}/web/archive/old", compression="gzip")
    return root


def _write_hostnames(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "hostnames")
    standin.hostnames(spark, sf_dir).write.csv(path, header=True, escape='"')
    return path


def _run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "pipeline")
    table = f"joined_log_table_{out[-32:]}"
    (
        pipeline(
            "apache_web_log",
            spark,
            output_location=f"{out}/lake",
            errors_location=f"{out}/errors",
            table=table,
            table_path=f"{out}/table",
        )
        .extract_log(_write_log_files(spark, sf_dir), "part-*", _write_hostnames(spark, sf_dir))
        .clean_log_record()
        .load_to_data_lake()
        .transform_data()
        .load_datawarehouse()
    )
    return spark.table(table)


def _warehouse_name(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "table")
    name = f"joined_log_table_{path[-32:]}"
    warehouse.create_table(_joined(spark, sf_dir), name, path=path)
    return name


def _read_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.read_log_lines(spark, _write_log_files(spark, sf_dir), "part-*")


def _read_hostname_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.read_hostnames(spark, _write_hostnames(spark, sf_dir))


def _reject_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "errors")
    text.write_rejects(rejects(standin.log_lines(spark, sf_dir)), path)
    return text.read_rejects(spark, path)


def _load_run(spark: SparkSession, out: str, run: str, lines: DataFrame, names: str | None = None, **options):
    """One run of the pipeline up to the lake, or up to the table if there are host names."""
    pipe = pipeline("apache_web_log", spark, output_location=out, run=run, **options).extract_lines(lines, names)
    pipe.clean_log_record().load_to_data_lake()
    return pipe.transform_data().load_datawarehouse() if names else pipe


def _parts_of_lines(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The log lines in three parts."""
    lines, value = standin.log_lines(spark, sf_dir), F.col("value")
    signup, click = value.contains("/signup/"), value.contains("/click/")
    return [lines.filter(signup), lines.filter(click & ~signup), lines.filter(~click & ~signup)]


def _lake_by_runs(spark: SparkSession, sf_dir: str) -> str:
    """A lake of three runs, of which one was repeated."""
    out = scratch_path(spark, "lake")
    parts = _parts_of_lines(spark, sf_dir)
    for n in (0, 1, 2, 1):
        _load_run(spark, out, f"run-{n}", parts[n])
    return out


def _lake_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.read_lake(spark, _lake_by_runs(spark, sf_dir))


def _rejects_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    Runs(spark, _lake_by_runs(spark, sf_dir)).create_view("rejected_lines")
    return spark.sql("SELECT value FROM rejected_lines")


def _lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lake after its small files were rewritten."""
    out = _lake_by_runs(spark, sf_dir)
    Runs(spark, out).compact()
    return lake.read_lake(spark, out)


def _lake_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a folder that grew in between, also by a folder with a hidden name."""
    root, out = scratch_path(spark, "logs"), scratch_path(spark, "lake")
    first, second, third = _parts_of_lines(spark, sf_dir)

    def load() -> None:
        pipe = pipeline("apache_web_log", spark, output_location=out, new_files_only=True)
        pipe.extract_log(root, "part-*", None).clean_log_record().load_to_data_lake()

    first.write.text(f"{root}/web")
    load()
    second.write.text(f"{root}/web/later", compression="gzip")
    third.write.text(f"{root}/web/.older")
    load()
    load()
    return lake.read_lake(spark, out)


def _lake_value_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in folders named by the bare status."""
    root, records = scratch_path(spark, "values"), _cleaned(spark, sf_dir)
    for row in records.select("status").distinct().collect():
        records.filter(F.col("status") == row["status"]).drop("status").write.parquet(f"{root}/{row['status']}")
    return lake.read_value_partitioned(spark, root, "status")


def _table_of_runs(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[str, str]:
    """A table that grew by three runs, the first of them with other host names; its lake and its name."""
    out = scratch_path(spark, "grown")
    name = f"joined_log_table_{out[-32:]}"
    options = {"table": name, "table_path": f"{out}/table", "table_mode": "runs", "buckets": buckets}
    old = scratch_path(spark, "hostnames")
    standin.hostnames_twice(spark, sf_dir).write.csv(old, header=True, escape='"')
    names = _write_hostnames(spark, sf_dir)
    for n, part in enumerate(_parts_of_lines(spark, sf_dir)):
        _load_run(spark, f"{out}/lake", f"run-{n}", part, names if n else old, **options)
    return f"{out}/lake", name


def _table_by_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_table_of_runs(spark, sf_dir)[1])


def _joined_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of records that are kept in buckets by host."""
    runs = Runs(spark, _lake_by_runs(spark, sf_dir))
    place = scratch_path(spark, "by-host")
    by_host = HostBuckets(spark, f"records_by_host_{place[-32:]}", place, buckets=8)
    by_host.sync(runs)
    return by_host.joined(standin.hostnames(spark, sf_dir), [m["folder"] for m in runs.live()]).drop(RUN)


def _report_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a table of runs, from its cells, and of its lake's rejects."""
    out, name = _table_of_runs(spark, sf_dir)
    return _totals(spark, report(spark, out, name))


def _top_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest request per hour of a table of runs, from those that each run has kept."""
    out, name = _table_of_runs(spark, sf_dir)
    return report(spark, out, name)["top_bytes_by_hour"]


def _totals(spark: SparkSession, outputs) -> DataFrame:
    totals = {name: outputs[name] for name in ("total_records", "total_errors", "total_mb")}
    return spark.sql("SELECT " + ", ".join(f"(SELECT * FROM {{{name}}}) AS {name}" for name in totals), **totals)


def _report_output(name: str) -> Query:
    """One output of the report over a stored table."""
    return lambda spark, sf_dir: report(spark, "", _warehouse_name(spark, sf_dir))[name]


def _map_column_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two functions of whole Arrow batches, chained."""
    records = _cleaned(spark, sf_dir).select("host", "request", "bytes")
    records = map_column(records, "bytes", lambda sizes: pc.add(sizes, 1), "bigint", batches=True)
    return map_column(records, "request", pc.utf8_reverse, "string", batches=True)


def _lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    lake.append_to_lake(_cleaned(spark, sf_dir), path)
    return lake.read_lake(spark, path)


def _lake_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at most 1,000 records."""
    return lake.append_in_chunks(_cleaned(spark, sf_dir), scratch_path(spark, "chunks"), rows=1_000)


def _lake_partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    lake.append_to_lake(_cleaned(spark, sf_dir), path, ["status", "method"])
    return lake.read_lake(spark, path)


def _lake_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    lake.append_to_lake(_cleaned(spark, sf_dir), path)
    return lake.repartition_lake(spark, path, scratch_path(spark, "by-method"), "method")


def _read_log_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed lines only, by the folders above them."""
    return text.read_log_lines(spark, _write_log_files(spark, sf_dir), "arch[!x]v*/*/part-*")


def _list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _warehouse_name(spark, sf_dir)
    return warehouse.list_tables(spark).filter(F.col("tableName") == name).select(F.substring("tableName", 1, 16).alias("table_name"))


def _reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.total_records(_reject_sink(spark, sf_dir)).withColumnRenamed("total_records", "total_errors")


def _report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the report over a stored table."""
    errors = scratch_path(spark, "errors")
    text.write_rejects(rejects(standin.log_lines(spark, sf_dir)), errors)
    return _totals(spark, report(spark, errors, _warehouse_name(spark, sf_dir)))


def _map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One native function and one plain Python function, chained."""
    records = _cleaned(spark, sf_dir).select("host", "request", "bytes")
    records = map_column(records, "bytes", lambda size: size + 1)
    return map_column(records, "request", lambda request: request[::-1], "string")


def _top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest request of each hour again, by row number."""
    rows = _joined(spark, sf_dir).withColumn("dt", hour_of_day(F.hour("datetime")))
    ties = [F.col(c).asc_nulls_last() for c in ("datetime", "request", "host", "hostname")]
    top = traffic.top_n_per_group(rows, ["dt"], [F.col("bytes").desc_nulls_last(), *ties])
    return top.select("dt", "hostname", (F.col("bytes") / 1000).alias("KB")).orderBy("dt")


def _mb_by_hour_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    statement = """
        SELECT strftime(datetime, '%H') AS log_hour, SUM(bytes) / 1000 / 1000 AS MB
        FROM {log} GROUP BY log_hour ORDER BY log_hour"""
    return spark.sql(statement, log=_joined(spark, sf_dir))


def queries() -> dict[str, Query]:
    return _own_queries() | ({"pipeline": corpus_pipeline.run, **llm.QUERIES} if llm else {})


def oracle_sql() -> dict[str, str]:
    if not llm:
        return _own_sql()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _own_sql() | whole | llm.ORACLE_SQL


def _own_queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "read_log_files": _read_log_files,
        "read_log_folders": _read_log_folders,
        "read_hostname_csv": _read_hostname_csv,
        "list_tables": _list_tables,
        "reject_sink": _reject_sink,
        "lake_roundtrip": _lake_roundtrip,
        "lake_chunks": _lake_chunks,
        "lake_partitioned_read": _lake_partitioned_read,
        "lake_repartition": _lake_repartition,
        "warehouse_table": lambda spark, sf_dir: spark.table(_warehouse_name(spark, sf_dir)),
        "describe_joined": lambda spark, sf_dir: warehouse.describe(spark, _warehouse_name(spark, sf_dir)),
        "pipeline_run": _run_pipeline,
        # runs
        "lake_runs": _lake_runs,
        "lake_new_files": _lake_new_files,
        "lake_compacted": _lake_compacted,
        "lake_value_folders": _lake_value_folders,
        "rejects_of_runs": _rejects_of_runs,
        "table_by_runs": _table_by_runs,
        "joined_by_host": _joined_by_host,
        "report_of_runs": _report_of_runs,
        "top_of_runs": _top_of_runs,
        # parse, clean, join
        "parse_log": lambda spark, sf_dir: parse(standin.log_lines(spark, sf_dir)),
        "clean_log": _cleaned,
        "map_column": _map_column,
        "map_column_batches": _map_column_batches,
        "rejects": lambda spark, sf_dir: rejects(standin.log_lines(spark, sf_dir)),
        "joined_log_table": _joined,
        "hostname_dup_join": lambda spark, sf_dir: join_hostnames(
            _cleaned(spark, sf_dir), standin.hostnames_twice(spark, sf_dir)
        ),
        # reports
        "total_records": _on_joined(traffic.total_records),
        "reject_count": _reject_count,
        "report_totals": _report_totals,
        "report_describe": _report_output("describe"),
        "report_mb_by_hour": _report_output("mb_by_hour"),
        "report_mb_by_status": _report_output("mb_by_status"),
        "report_mb_by_method": _report_output("mb_by_method"),
        "report_top_bytes_by_hour": _report_output("top_bytes_by_hour"),
        "report_moving_avg": _report_output("moving_avg"),
        "total_mb": _on_joined(traffic.total_mb),
        "mb_by_status": _on_joined(traffic.mb_by, "status"),
        "mb_by_method": _on_joined(traffic.mb_by, "method"),
        "mb_by_hour": _on_joined(traffic.mb_by_hour),
        "mb_by_hour_sql": _mb_by_hour_sql,
        "top_bytes_by_hour": _on_joined(traffic.top_bytes_by_hour),
        "top_n_per_group": _top_n_per_group,
        "moving_avg_4h": _on_joined(moving_avg_per_record),
    }


def _own_sql() -> dict[str, str]:
    lines, names = f"WITH {standin.LINES_SQL}", f"WITH {standin.NAMES_SQL}"
    cleaned, joined = f"WITH {standin.CLEANED_SQL}", f"WITH {standin.JOINED_SQL}"
    rejected = f"{lines} SELECT value FROM lines WHERE NOT regexp_matches(value, {standin.PATTERN_SQL})"
    fields = ", ".join(f'"{f}"' for f in FIELDS)
    all_cleaned, all_joined = f"{cleaned} SELECT * FROM cleaned", f"{joined} SELECT * FROM joined_log_table"
    by_hour = f"""{joined} SELECT strftime(datetime, '%H') AS log_hour, sum(bytes) / 1000 / 1000 AS MB
            FROM joined_log_table GROUP BY log_hour ORDER BY log_hour"""
    top = f"""{joined}, ranked AS (
              SELECT strftime(datetime, '%H') AS dt, hostname, bytes, row_number() OVER (
                PARTITION BY strftime(datetime, '%H')
                ORDER BY bytes DESC, datetime, request, host, hostname) AS rn
              FROM joined_log_table)
            SELECT dt, hostname, bytes / 1000 AS KB FROM ranked WHERE rn = 1 ORDER BY 1"""
    totals = f"""{joined} SELECT
              (SELECT count(*) FROM joined_log_table) AS total_records,
              (SELECT count(*) FROM ({rejected})) AS total_errors,
              (SELECT sum(bytes) / 1000 / 1000 FROM joined_log_table) AS total_mb"""
    described = f"""
            SELECT column_name AS col_name,
              CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                ELSE lower(column_type) END AS data_type,
              CAST(NULL AS VARCHAR) AS comment
            FROM (DESCRIBE {all_joined})"""
    by_status, by_method = (
        f"""{joined} SELECT {key}, sum(bytes) / 1000 / 1000 AS MB
            FROM joined_log_table GROUP BY {key} HAVING MB > 0 ORDER BY MB"""
        for key in ("status", "method")
    )
    mapped = f"{cleaned} SELECT host, reverse(request) AS request, bytes + 1 AS bytes FROM cleaned"
    moving = f"""{joined} SELECT strftime(datetime, '%H') AS dt,
              avg(bytes) OVER (ORDER BY datetime
                RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND INTERVAL 2 HOURS FOLLOWING) AS bytes_5_hours_mov_avg
            FROM joined_log_table ORDER BY 1, 2"""
    return {
        "lake_runs": all_cleaned,
        "lake_new_files": all_cleaned,
        "lake_compacted": all_cleaned,
        "lake_value_folders": all_cleaned,
        "rejects_of_runs": rejected,
        "table_by_runs": all_joined,
        "joined_by_host": all_joined,
        "report_of_runs": totals,
        "top_of_runs": top,
        "report_describe": described,
        "report_mb_by_hour": by_hour,
        "report_mb_by_status": by_status,
        "report_mb_by_method": by_method,
        "report_top_bytes_by_hour": top,
        "report_moving_avg": moving,
        "map_column_batches": mapped,
        "read_log_files": f"{lines} SELECT value FROM lines",
        "read_log_folders": f"{lines} SELECT value FROM lines WHERE contains(value, '/signup/')",
        "list_tables": "SELECT 'joined_log_table' AS table_name",
        "report_totals": totals,
        "read_hostname_csv": f"{names} SELECT client, hostname FROM names",
        "reject_sink": rejected,
        "lake_roundtrip": all_cleaned,
        "lake_chunks": all_cleaned,
        "lake_partitioned_read": all_cleaned,
        "lake_repartition": all_cleaned,
        "warehouse_table": all_joined,
        "describe_joined": described,
        "pipeline_run": all_joined,
        "parse_log": f"WITH {standin.PARSED_SQL} SELECT {fields} FROM parsed",
        "clean_log": all_cleaned,
        "map_column": mapped,
        "rejects": rejected,
        "joined_log_table": all_joined,
        "hostname_dup_join": f"""{cleaned}, {standin.NAMES_SQL}, twice AS (
              SELECT client, hostname FROM names UNION ALL SELECT client, 'alt.' || hostname FROM names)
            SELECT host, datetime, method, request, status, bytes, hostname
            FROM cleaned LEFT JOIN twice ON host = client""",
        "total_records": f"{joined} SELECT count(*) AS total_records FROM joined_log_table",
        "reject_count": f"SELECT count(*) AS total_errors FROM ({rejected})",
        "total_mb": f"{joined} SELECT sum(bytes) / 1000 / 1000 AS total_mb FROM joined_log_table",
        "mb_by_status": by_status,
        "mb_by_method": by_method,
        "mb_by_hour": by_hour,
        "mb_by_hour_sql": by_hour,
        "top_bytes_by_hour": top,
        "top_n_per_group": top,
        "moving_avg_4h": moving,
    }
