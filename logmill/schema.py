"""Fixed schemas: field order of a log line, the lake, the joined table."""

from pyspark.sql import types as T

# The eleven fields of a log line, in the order they are written.
# ``referrer`` is the ident position; the HTTP referer is ``http_referred``.
FIELDS = (
    "host",
    "referrer",
    "user",
    "datetime",
    "method",
    "request",
    "proto",
    "status",
    "bytes",
    "http_referred",
    "user_agent",
)

_TYPES = {"bytes": T.LongType(), "datetime": T.TimestampNTZType(), "status": T.LongType()}

# The lake holds the same fields by name, in alphabetical order.
LOG_SCHEMA = T.StructType([T.StructField(f, _TYPES.get(f, T.StringType())) for f in sorted(FIELDS)])

# Columns of the warehouse table, in order.
JOINED_COLUMNS = ("host", "datetime", "method", "request", "status", "bytes", "hostname")

# The same with their types.
JOINED_SCHEMA = "host string, datetime timestamp_ntz, method string, request string, status bigint, bytes bigint, hostname string"

# Fields that can be empty text. A partition folder cannot tell '' from null.
MAYBE_EMPTY = ("http_referred", "user_agent")

# A list of files: what tells one version of a file from another.
FILES_SCHEMA = "path string, modified timestamp, length bigint"
