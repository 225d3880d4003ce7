"""Explicit schemas for the semi-structured inputs and stored intermediates.

Declaring the log schema avoids a full inference pass over the input and makes a
field that is absent from every record read as NULL instead of failing analysis.
Log scalars are read as text: a producer that quotes a number, or sends a fraction,
must not turn the whole record into NULLs. Numbers are cast where they are used
(``functions.dates.epoch_count``); ``time`` is only ever tested for NULL.
"""

from pyspark.sql import types as T

PAGE_STAY_ITEM = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("enter", T.StringType()),    # epoch seconds
    T.StructField("exit", T.StringType()),     # epoch seconds
    T.StructField("title", T.StringType()),
])

CLICK_ITEM = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("position", T.StringType()),  # "x,y"
    T.StructField("title", T.StringType()),
    T.StructField("type", T.StringType()),
])

LOG_RECORD = T.StructType([
    T.StructField("custom_uuid", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("rectime", T.StringType()),  # epoch milliseconds
    T.StructField("vercode", T.StringType()),
    T.StructField("vername", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("packageName", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("launcher_page_stay", T.ArrayType(PAGE_STAY_ITEM)),
        T.StructField("home_item_click", T.ArrayType(CLICK_ITEM)),
    ])),
])

# stored page-stay table (R6 output); enter/exit are local wall clocks, staySeconds the
# difference of the instants (a wall-clock difference is wrong across a DST change)
PAGE_STAY = T.StructType([
    T.StructField("custom_uuid", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("site", T.StringType()),
    T.StructField("vercode", T.StringType()),
    T.StructField("vername", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("enter", T.TimestampNTZType()),
    T.StructField("exit", T.TimestampNTZType()),
    T.StructField("staySeconds", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("dt", T.StringType()),
])

# stored daily order fact (R4 output)
DAILY_FACT = T.StructType([
    T.StructField("date", T.StringType()),   # yyyyMMdd
    T.StructField("channelName", T.StringType()),
    T.StructField("vipType", T.IntegerType()),
    T.StructField("packageName", T.StringType()),
    T.StructField("sellCount", T.LongType()),
    T.StructField("moneyCount", T.DoubleType()),
])
