"""A warehouse table that grows by runs.

The table is a view of the seven columns over a table with a partition for each run of the lake.
Joined records are written first, to a folder of their own; ``ALTER TABLE ADD PARTITION`` then
makes them part of the table: one step of the catalog, which is the commit. A load that is killed
before leaves files that nothing refers to, and one that is repeated finds its runs there.

The host names that a table was joined to are known by a hash of the whole list. When it differs,
all runs are joined again into a new table, and the view is put on that one: again one step.

Beside the records, each run's traffic cells and its largest requests per hour (``traffic.traffic_cells``,
``traffic.top_rows_by_hour``) are kept the same way. Cells add up, so totals of the table are sums over
the cells of its runs, and its largest requests are among those of its runs.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.operators.traffic import CELL_SCHEMA, TOP_SCHEMA, top_rows_by_hour, traffic_cells
from logmill.schema import JOINED_COLUMNS, JOINED_SCHEMA
from logmill.sources.runs import RUN, Runs
from logmill.sources.store import Store
from logmill.sources.warehouse import quoted

_ROWS, _CELLS, _TOPS, _NAMES = "logmill.rows", "logmill.cells", "logmill.tops", "logmill.names"
#: The tables behind the view. A partition of the first is a run's commit, so it comes last.
_TABLES = {_ROWS: JOINED_SCHEMA, _CELLS: CELL_SCHEMA, _TOPS: TOP_SCHEMA}

_AT_ONCE = 200  # partitions added by one statement


def names_hash(names: DataFrame) -> str:
    """A hash of a host name list that doesn't depend on the order of its rows, but on their number."""
    of_row = F.xxhash64("client", "hostname")
    told = names.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(of_row).alias("x"),
        F.sum(F.xxhash64(of_row, F.lit(1)).cast("decimal(38,0)")).alias("s"),
    ).first()
    return f"{told['n']}:{told['x']}:{told['s']}"


class RunTable:
    """The table ``name``; ``path`` puts its files there instead of in the warehouse folder."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None):
        self.spark, self.name = spark, name
        self.path = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}.runs").rstrip("/")

    def state(self) -> dict[str, str] | None:
        """The tables behind the view, and the host names' hash; None if there is no such view."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {quoted(self.name)}").collect()
        told = {r["key"]: r["value"] for r in found if r["key"] in (*_TABLES, _NAMES)}
        return told if len(told) == len(_TABLES) + 1 else None

    def loaded(self, table: str) -> set[str]:
        """The run folders that a table behind the view holds."""
        return {r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()}

    def update(self, runs: Runs, names: DataFrame, joined: Callable[[list[str]], DataFrame]) -> dict[str, int]:
        """Join the lake's runs that the table doesn't have yet, or all if the names have changed.

        ``joined`` gives the joined records of run folders, with ``run``. Returns how many runs
        were joined and how many the table has. A folder into which earlier runs were rewritten
        counts as they do; one of which the table has a part makes it whole again.
        """
        state, hash_ = self.state(), names_hash(names)
        if state is None and self.spark.catalog.tableExists(self.name):
            raise ValueError(f"{self.name} is there, but no table of runs")
        live = {m["folder"]: m["origins"] for m in runs.live()}
        origins = {m["folder"]: o for m, o in runs.history()}
        have = self.loaded(state[_ROWS]) if state else set()
        held = {o for folder in have for o in origins.get(folder, {folder})}
        pending = [folder for folder, own in live.items() if not own <= held]
        whole = state is None or state[_NAMES] != hash_ or any(live[folder] & held for folder in pending)
        if whole:
            pending, have = list(live), set()
            state = self._new_tables(hash_)
        if pending:
            self._load(state, pending, joined(pending))
        if whole:
            self._exchange(state)
        return {"joined": len(pending), "runs": len(have) + len(pending)}

    def _load(self, state: dict, folders: list[str], joined: DataFrame) -> None:
        place = f"{self._generation(state)}/load-{uuid4().hex}"
        joined.write.partitionBy(RUN).parquet(f"{place}/rows")
        rows = self.spark.read.schema(f"{JOINED_SCHEMA}, {RUN} string").parquet(f"{place}/rows")
        traffic_cells(rows, RUN).write.partitionBy(RUN).parquet(f"{place}/cells")
        top_rows_by_hour(rows, RUN).write.partitionBy(RUN).parquet(f"{place}/tops")
        for key in reversed(_TABLES):
            parts = []
            for folder in folders:
                own = f"{place}/{key.rpartition('.')[2]}/{RUN}={folder}"
                Store(self.spark, own).make_folder(own)  # a run without records has none
                parts.append(f"PARTITION ({RUN} = '{folder}') LOCATION '{_text(own)}'")
            for at in range(0, len(parts), _AT_ONCE):
                some = " ".join(parts[at : at + _AT_ONCE])
                self.spark.sql(f"ALTER TABLE {quoted(state[key])} ADD IF NOT EXISTS {some}")

    def _generation(self, state: dict[str, str]) -> str:
        """Folder of all loads into the tables that are behind the view, until it is put on others."""
        return f"{self.path}/{state[_ROWS]}"

    def _new_tables(self, hash_: str) -> dict[str, str]:
        own = uuid4().hex
        names = {key: f"{self.name}_{key.rpartition('.')[2]}_{own}" for key in _TABLES}
        for key, schema in _TABLES.items():
            self.spark.sql(
                f"CREATE TABLE {quoted(names[key])} ({schema}, {RUN} STRING) USING parquet PARTITIONED BY ({RUN}) "
                f"LOCATION '{_text(f'{self._generation(names)}/{names[key]}')}'"
            )
        return names | {_NAMES: hash_}

    def _exchange(self, state: dict[str, str]) -> None:
        """Put the view on new tables and drop those that it was on, with their files."""
        old = self.state()
        told = ", ".join(f"'{k}' = '{v}'" for k, v in state.items())
        columns = ", ".join(JOINED_COLUMNS)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {quoted(self.name)} TBLPROPERTIES ({told}) "
            f"AS SELECT {columns} FROM {quoted(state[_ROWS])}"
        )
        for key in _TABLES if old else ():
            self.spark.sql(f"DROP TABLE IF EXISTS {quoted(old[key])}")
        if old:
            Store(self.spark, self.path).delete(self._generation(old))

    def cells(self) -> DataFrame | None:
        """The traffic cells of the runs that the table has; None if it is no table of runs."""
        return self._kept(_CELLS)

    def tops(self) -> DataFrame | None:
        """The largest requests per hour of the runs that the table has; None as ``cells``."""
        return self._kept(_TOPS)

    def _kept(self, key: str) -> DataFrame | None:
        state = self.state()
        if state is None:
            return None
        have = self.spark.sql(f"SHOW PARTITIONS {quoted(state[_ROWS])}")
        have = have.select(F.substring_index("partition", "=", -1).alias(RUN))
        return self.spark.table(state[key]).join(have, RUN, "left_semi").drop(RUN)


def _text(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
