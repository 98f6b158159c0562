"""Column names, table schemas and the missing-value sentinel."""

from pyspark.sql import types as T

# Fixed values.
SENTINEL = "unknown"
MODEL = "model"
PRICE = "price_USD"
BRAND = "brand"
RAM = "ram_GB"
CLOCK = "gpu_clock_speed_MHz"
DATE = "date"
OFFER_COLUMNS = [MODEL, PRICE, BRAND, RAM, CLOCK, DATE]

RAW_OFFER = T.StructType([
    T.StructField(MODEL, T.StringType()),
    T.StructField(PRICE, T.StringType()),
    T.StructField(BRAND, T.StringType()),
    T.StructField(RAM, T.StringType()),
    T.StructField(CLOCK, T.StringType()),
    T.StructField(DATE, T.DateType()),
])

OFFER = T.StructType([
    T.StructField(MODEL, T.StringType()),
    T.StructField(PRICE, T.DoubleType()),
    T.StructField(BRAND, T.StringType()),
    T.StructField(RAM, T.DoubleType()),
    T.StructField(CLOCK, T.DoubleType()),
    T.StructField(DATE, T.DateType()),
])

# One fetched listing page; ``error`` is NULL, "connection", "timeout" or "request".
CRAWL_PAGE = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("html", T.StringType()),
])

# One fetched offer page, stored under the place of the link that led to it: a page may
# list one address twice.
FETCHED_OFFER = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("html", T.StringType()),
])

# What happened in a run; ``page_no`` is where a run stopped.
RUN_REPORT = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("stage", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("page_no", T.IntegerType()),
])
