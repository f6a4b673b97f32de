"""Stand-in log lines and host names, derived from the driver's tables.

Every event is one request and every customer one named client; nothing is
filtered. The rules make text only: malformed lines, empty sizes and hosts
outside the client network are there for the operators to deal with.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = "concat(if(event_type = 'error', '10.1.', '10.0.'), user_id div 256, '.', user_id % 256)"
    stamp = "concat('[', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0330]')"
    method = "case event_type when 'purchase' then 'POST' when 'signup' then 'PUT' else 'GET' end"
    status = "case event_type when 'error' then 500 when 'signup' then 201 else 200 end"
    size = "if(event_id % 13 = 0, '-', cast(cast(round(value * 100) as bigint) as string))"
    good = (
        f"concat({host}, ' - - ', {stamp}, ' \"', {method}, ' /', event_type, '/', event_id, ' HTTP/1.1\" ', "
        f"{status}, ' ', {size}, ' \"-\" \"ua ', event_type, '\"')"
    )
    bad = f"concat({host}, ' - - ', {stamp}, ' \"-\" 400 0 \"-\" \"-\"')"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.expr(f"if(event_id % 97 = 0, {bad}, {good})").alias("value"))


def hostnames(spark: SparkSession, sf_dir: str) -> DataFrame:
    client = "concat('10.0.', c_custkey div 256, '.', c_custkey % 256)"
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers.select(F.expr(client).alias("client"), F.col("c_name").alias("hostname"))


def hostnames_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every client listed a second time under a second name."""
    once = hostnames(spark, sf_dir)
    return once.unionByName(once.withColumn("hostname", F.concat(F.lit("alt."), "hostname")))


# The same in DuckDB: relations ``lines`` and ``names``, then what the pipeline makes of them.
_HOST = "'.' || (user_id // 256) || '.' || (user_id % 256)"
_STAMP = "'[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0330]'"
LINES_SQL = f"""lines AS (
  SELECT CASE WHEN event_type = 'error' THEN '10.1' ELSE '10.0' END || {_HOST} || ' - - ' || {_STAMP} ||
    CASE WHEN event_id % 97 = 0 THEN ' "-" 400 0 "-" "-"' ELSE
      ' "' || CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END ||
      ' /' || event_type || '/' || event_id || ' HTTP/1.1" ' ||
      CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '201' ELSE '200' END || ' ' ||
      CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END ||
      ' "-" "ua ' || event_type || '"' END AS value
  FROM events)"""
NAMES_SQL = """names AS (
  SELECT '10.0.' || (c_custkey // 256) || '.' || (c_custkey % 256) AS client, c_name AS hostname FROM customer)"""

# Fixed value: the line pattern, which must equal the parser's.
PATTERN_SQL = r"""'^(\S+) (\S+) (\S+) \[(.*?)\] "(\S+) (\S+) (\S+)" (\S+) (\S+) "(.*?)" "(.*?)"'"""
PARSED_SQL = f"""{LINES_SQL}, parsed AS (
  SELECT f.* FROM (
    SELECT regexp_extract(value, {PATTERN_SQL}, ['host', 'referrer', 'user', 'datetime', 'method', 'request',
      'proto', 'status', 'bytes', 'http_referred', 'user_agent']) AS f
    FROM lines WHERE regexp_matches(value, {PATTERN_SQL})))"""
CLEANED_SQL = f"""{PARSED_SQL}, cleaned AS (
  SELECT CASE WHEN bytes = '-' THEN 0 ELSE CAST(bytes AS BIGINT) END AS bytes,
    CASE WHEN datetime = '' THEN TIMESTAMP '1900-01-01' ELSE strptime(datetime[1:20], '%d/%b/%Y:%H:%M:%S')
      + to_microseconds(CAST(rpad(datetime[23:], 6, '0') AS BIGINT)) END AS datetime,
    host, http_referred, method, proto, referrer, request, CAST(status AS BIGINT) AS status, "user", user_agent
  FROM parsed)"""
JOINED_SQL = f"""{CLEANED_SQL}, {NAMES_SQL}, joined_log_table AS (
  SELECT host, datetime, method, request, status, bytes, hostname
  FROM cleaned LEFT JOIN names ON host = client)"""
