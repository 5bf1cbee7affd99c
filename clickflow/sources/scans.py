"""Scans and decoders.

Every parser works on a DataFrame with one text column ``value`` so the same
code serves files (``spark.read.text``), file streams and topic streams. Bad
records are not fatal: ``_bad`` marks rows whose required fields did not
parse (the reference would fail the whole job on them), and ``good`` /
``bad`` split them so a job can count or park them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow import schemas

BEHAVIOR_REQUIRED = ["user_id", "item_id", "category_id", "behavior", "ts_sec"]
AD_CLICK_REQUIRED = ["user_id", "ad_id", "province", "city", "ts_sec"]
ACCESS_LOG_REQUIRED = ["ip", "ts_ms", "method", "url"]

# Web-log time layout (field 3) and zone field (field 4).
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss Z"
CORRUPT = "_corrupt"


def parsed_once(df: DataFrame, cols: list[Column]) -> DataFrame:
    """Project ``cols`` so each is computed once per row.

    The optimizer substitutes a parsed column into every filter that uses it
    and pushes such filters down towards the scan, so a bad-row check on
    five fields would re-parse the line five times inside the scan task.
    Emitting the parsed record through a one-element ``inline`` keeps the
    parse in one place: filters on its output stay above it.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def _flag_bad(df: DataFrame, required: list[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.withColumn("_bad", missing)


def good(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_bad")).drop("_bad")


def bad(df: DataFrame) -> DataFrame:
    return df.where(F.col("_bad"))


def ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def _csv(df: DataFrame, schema, required: list[str], value_col: str) -> DataFrame:
    """Split on ``,`` (no quoting, as the reference does) and cast each field;
    a field that does not cast is NULL and marks the row bad. ``split`` +
    ``try_cast`` stays cheap even where the optimizer repeats it per field."""
    parts = F.split(F.col(value_col), ",")
    cols = [F.try_element_at(parts, F.lit(i + 1)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema)]
    return _flag_bad(parsed_once(df, cols), required)


def parse_behavior_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``user_id,item_id,category_id,behavior,ts_sec[,seq]`` lines."""
    return _csv(df, schemas.BEHAVIOR, BEHAVIOR_REQUIRED, value_col)


def parse_ad_click_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: ``user_id,ad_id,province,city,ts_sec[,seq]`` lines."""
    return _csv(df, schemas.AD_CLICK, AD_CLICK_REQUIRED, value_col)


def parse_access_log_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Space-separated web-log lines.

    Fields: 0 ip, 1 user, 3 time ``dd/MM/yyyy:HH:mm:ss``, 4 zone, 5 method,
    6 url. The zone field is honoured (the reference used the JVM zone);
    an unparsable time gives a NULL ``ts_ms`` and marks the row bad.
    """
    f = F.split(F.col(value_col), " ")

    def at(i: int) -> Column:
        return F.try_element_at(f, F.lit(i + 1))

    ts = F.try_to_timestamp(F.concat_ws(" ", at(3), at(4)),
                            F.lit(ACCESS_LOG_TIME_FORMAT))
    out = parsed_once(df, [at(0).alias("ip"), at(1).alias("user"),
                           F.unix_millis(ts).alias("ts_ms"), at(5).alias("method"),
                           at(6).alias("url")])
    return _flag_bad(out, ACCESS_LOG_REQUIRED)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_behavior_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_behavior_lines(read_lines(spark, path))


def read_ad_click_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_ad_click_lines(read_lines(spark, path))


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_access_log_lines(read_lines(spark, path))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int,
              upper: int, num_partitions: int, fetch_size: int = 10_000,
              options: dict[str, str] | None = None) -> DataFrame:
    """S6 over a database: ``table`` (or a parenthesised query) read in
    parallel ranges of ``partition_column`` (bounds set the stride only; rows
    outside them are read too). Needs the driver jar on the classpath."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("partitionColumn", partition_column).option("lowerBound", str(lower))
         .option("upperBound", str(upper)).option("numPartitions", str(num_partitions))
         .option("fetchsize", str(fetch_size)))
    return r.options(**(options or {})).load()


def sql_rows(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL text; rows keep their column labels."""
    return spark.sql(sql)


def decode_json(df: DataFrame, schema, value_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """JSON text -> typed columns, parsed once per record. Text that is
    NULL or no JSON object of these types is marked ``_bad`` (the reference
    failed the batch on it); split with ``good`` and ``bad``. ``keep`` names
    columns to carry along, e.g. the text itself for a quarantine."""
    keep = keep or []
    # the raw text lands in the extra field exactly when it is malformed
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    j = parsed_once(df, [*[F.col(c) for c in keep], F.from_json(
        F.col(value_col), with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("_j")])
    return j.select(*keep, *[F.col("_j")[f.name].alias(f.name) for f in schema],
                    (F.col("_j").isNull() | F.col("_j")[CORRUPT].isNotNull()).alias("_bad"))


def decode_orders(df: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                  fields: list[str] | None = None) -> DataFrame:
    """Order JSON -> the order record and ``_bad``; absent fields are
    NULL. A malformed record, or one without an id, is bad. With ``fields`` only
    the id and these are parsed and checked (a record's other fields may have
    any type) and come out: a bad-record check needs every field it parses, so
    the optimizer cannot leave out those that are not used."""
    known = [f for f in schemas.ORDER_INPUT if fields is None or f.name in {"id", *fields}]
    d = decode_json(df, T.StructType(known), value_col, keep)
    cols = [f.name for f in known]
    if fields is None:
        cols += [F.lit(None).cast(t).alias(n) for n, t in schemas.ORDER_FIELDS[11:]]
    return d.select(*(keep or []), *cols, (F.col("_bad") | F.col("id").isNull()).alias("_bad"))
