"""Fixed schemas of the inputs and typed records."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, I, D = T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# CSV: user_id,item_id,category_id,behavior,ts_sec[,seq]. ``seq`` is the
# arrival order (file line / topic offset); absent in plain files.
BEHAVIOR = _struct(("user_id", L), ("item_id", L), ("category_id", I),
                   ("behavior", S), ("ts_sec", L), ("seq", L))

# CSV: user_id,ad_id,province,city,ts_sec[,seq]
AD_CLICK = _struct(("user_id", L), ("ad_id", L), ("province", S),
                   ("city", S), ("ts_sec", L), ("seq", L))

# Web log after parsing.
ACCESS_LOG = _struct(("ip", S), ("user", S), ("ts_ms", L), ("method", S),
                     ("url", S))

MARKETING = _struct(("user_id", L), ("behavior", S), ("channel", S),
                    ("ts_ms", L), ("seq", L))

# App log JSON. ``start`` is kept as raw text: only its presence matters.
APP_LOG = T.StructType([
    T.StructField("common", _struct(("mid", S), ("uid", S), ("ar", S),
                                    ("ch", S), ("vc", S))),
    T.StructField("start", S),
    T.StructField("ts", L),
])

# CDC envelope with an array of row objects; each element kept as JSON text.
CDC_ARRAY = _struct(("table", S), ("data", T.ArrayType(S)))
# CDC envelope with one row object, kept as JSON text.
CDC_OBJECT = _struct(("table", S), ("data", S))

# The same with what orders and types the change.
CDC_CHANGE = _struct(("table", S), ("type", S), ("ts", L), ("xid", L), ("data", S))

# Order record (S8); enrichment fields are filled downstream.
ORDER_FIELDS = [
    ("id", L), ("province_id", L), ("order_status", S), ("user_id", L),
    ("final_total_amount", D), ("benefit_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D), ("expire_time", S),
    ("create_time", S), ("operate_time", S), ("create_date", S),
    ("create_hour", S), ("if_first_order", S), ("province_name", S),
    ("province_area_code", S), ("province_iso_code", S),
    ("user_age_group", S), ("user_gender", S),
]
ORDER = _struct(*ORDER_FIELDS)
ORDER_INPUT = _struct(*ORDER_FIELDS[:11])

DAU_DOC_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]
