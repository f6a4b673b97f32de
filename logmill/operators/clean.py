"""Text fields to typed columns."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logmill.functions import stamp_parts, to_bytes, to_datetime, to_status


def map_column(
    df: DataFrame,
    name: str,
    func: Callable,
    return_type: T.DataType | str | None = None,
    batches: bool = False,
) -> DataFrame:
    """Replace column ``name`` by a function of itself.

    Without ``return_type``, ``func`` maps a Column to a Column and stays in the
    JVM. With it, ``func`` is a Python function of one value; the values travel
    in Arrow batches. With ``batches`` it is a function of a whole batch, an Arrow
    array to an Arrow array of the same length, and no value becomes a Python object.
    A batch function is called once for each batch of a partition
    (``spark.sql.execution.arrow.maxRecordsPerBatch``), nulls included; another length or
    type of the result stops the job.
    """
    if batches:
        if return_type is None:
            raise ValueError("a batch function needs a return type")
        func = F.arrow_udf(_array_function(func), return_type)
    elif return_type is not None:
        func = F.udf(func, return_type, useArrow=True)
    return df.withColumn(name, func(F.col(name)))


def _array_function(func: Callable) -> Callable:
    """``func`` as Spark wants it: with types that say what it takes, and one array as its answer."""

    def convert(values: pa.Array) -> pa.Array:
        found = func(values)
        return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found

    return convert


def clean(df: DataFrame, offset_mode: str = "reference", on_bad_value: str = "fail") -> DataFrame:
    """Convert ``bytes``, ``status`` and ``datetime``.

    ``on_bad_value="fail"`` stops the job at text that does not convert;
    ``"null"`` leaves a null there. A null field, of a line that did not match,
    stays null.
    """
    if on_bad_value not in ("fail", "null"):
        raise ValueError(f"on_bad_value must be 'fail' or 'null', not {on_bad_value!r}")
    parts = "datetime_parts"
    df = df.withColumn(parts, stamp_parts(F.col("datetime"), offset_mode))
    rules: dict[str, Callable[[Column], Column]] = {
        "bytes": to_bytes,
        "status": to_status,
        "datetime": lambda text: to_datetime(text, F.col(parts), offset_mode),
    }
    for name, rule in rules.items():
        df = map_column(df, name, _strict(name, rule) if on_bad_value == "fail" else rule)
    return df.drop(parts)


def _strict(name: str, rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def convert(text: Column) -> Column:
        stop = F.raise_error(F.concat(F.lit(f"bad {name} in log line: "), text))
        return F.when(text.isNotNull(), F.coalesce(rule(text), stop))

    return convert
