"""Host names for log records."""

from pyspark.sql import DataFrame

from logmill.schema import JOINED_COLUMNS


def join_hostnames(logs: DataFrame, hostnames: DataFrame, *keep: str) -> DataFrame:
    """Left join on ``host = client``, keeping the seven warehouse columns and those in ``keep``.

    A host that is not listed keeps a null name; a client listed twice gives its
    rows twice. There is no join hint: Spark broadcasts the names only when their
    size, estimated or seen at run time, is under its own threshold, and
    otherwise shuffles both sides, where AQE cuts the partition of a hot host
    into pieces of the log side (``plans.session`` turns that on).
    """
    names = hostnames.select("client", "hostname")
    return logs.join(names, logs["host"] == names["client"], "left").select(*JOINED_COLUMNS, *keep)
