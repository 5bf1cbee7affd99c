"""Change-data-capture splitting.

Envelopes arrive as JSON text ``value``. Each row object is routed to the
topic ``ODS_<TABLE>`` as JSON text. Envelopes without ``data`` (DDL,
heartbeats) are filtered out instead of failing the batch; malformed ones are
in ``bad_envelopes``. The splitters ignore the operation type (deletes pass as
rows); ``latest_changes`` and ``live_rows`` apply it. An envelope is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.sources.scans import bad, decode_json, good

# Topic prefix.
TOPIC_PREFIX = "ODS_"


def topic_for(table: Column) -> Column:
    """P5: ``ODS_`` + upper-cased table name."""
    return F.concat(F.lit(TOPIC_PREFIX), F.upper(table))


def cdc_split_array(envelopes: DataFrame) -> DataFrame:
    """``{"table":..,"data":[{..},..]}`` -> one (topic, value) per row
    object. The element schema is ``string`` so each object is passed on as
    its JSON text, not re-typed."""
    e = good(decode_json(envelopes, schemas.CDC_ARRAY))
    return (e.where(F.col("data").isNotNull())
            .select(topic_for(F.col("table")).alias("topic"), F.explode("data").alias("value")))


def cdc_split_object(envelopes: DataFrame) -> DataFrame:
    """``{"table":..,"data":{..}}`` -> (topic, value) with the data
    object as JSON text (one parse per envelope: ``data`` is read as a
    string, which keeps the object's JSON text)."""
    e = good(decode_json(envelopes, schemas.CDC_OBJECT))
    return (e.where(F.col("data").isNotNull())
            .select(topic_for(F.col("table")).alias("topic"), F.col("data").alias("value")))


def bad_envelopes(envelopes: DataFrame, form: str = "object") -> DataFrame:
    """The envelopes that are no JSON of the form ('array' or 'object'): value."""
    schema = schemas.CDC_ARRAY if form == "array" else schemas.CDC_OBJECT
    return bad(decode_json(envelopes, schema, keep=["value"])).select("value")


def for_topic(routed: DataFrame, topic: str) -> DataFrame:
    return routed.where(F.col("topic") == topic).select("value")


# ---- applying changes ---------------------------------------------------------

CHANGES = "table string, key string, ts long, seq long, type string, value string"
DELETE = "delete"


def changes(envelopes: DataFrame, key: str = "id") -> DataFrame:
    """table, key, ts, seq, type, value of each row change: ``ts`` and ``seq``
    (``xid``) order the changes of a key, ``key`` is the row's ``key`` field as
    text. Envelopes without data or key are left out."""
    e = good(decode_json(envelopes, schemas.CDC_CHANGE)).where(F.col("data").isNotNull())
    return e.select("table", F.get_json_object("data", f"$.{key}").alias("key"), "ts",
                    F.col("xid").alias("seq"), F.lower("type").alias("type"),
                    F.col("data").alias("value")).where(F.col("key").isNotNull())


def latest_changes(*parts: DataFrame) -> DataFrame:
    """The last change of each (table, key) by (ts, seq) over all ``parts``:
    rows of ``changes``, or of an earlier result. Deletes stay as tombstones,
    so that an older change which arrives later does not bring a row back. The
    order and repetition of the changes make no difference; of two changes with
    equal ts and seq the greater (type, value) counts."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    last = every.groupBy("table", "key").agg(
        F.max(F.struct("ts", "seq", "type", "value")).alias("c"))
    return last.select("table", "key", "c.ts", "c.seq", "c.type", "c.value")


def live_rows(latest: DataFrame) -> DataFrame:
    """The rows that are not deleted: table, key, ts, seq, value."""
    return latest.where(~F.col("type").eqNullSafe(F.lit(DELETE))).drop("type")
