"""Row types used across the library, declared once.

Streams never infer schemas; every source and stateful processor below uses one of these.
"""

from pyspark.sql import types as T

# The five-column behaviour log: user,item,category,behaviour,epoch-seconds.
USER_BEHAVIOR_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("epoch_s", T.LongType()),
])

# Changelog rows of a continuously updated group count.
CHANGELOG_OUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("cnt", T.LongType()),
    T.StructField("op_seq", T.IntegerType()),
])

# A row tagged against the watermark it met on arrival.
LATE_OUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("wm", T.TimestampType()),
    T.StructField("status", T.StringType()),
])

# Arrival report or processing-time alarm for a key.
ALARM_OUT = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("at_ms", T.LongType()),
])

# Outcome of matching an order with its first payment.
RECONCILE_OUT = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("at_ms", T.LongType()),
])
