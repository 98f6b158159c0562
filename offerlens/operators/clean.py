"""The cleaning of a raw offer batch and its all-or-nothing verdict."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions import parse
from offerlens.schema import BRAND, CLOCK, DATE, MODEL, PRICE, RAM


def clean_offers(raw: DataFrame) -> DataFrame:
    """Typed offers. ``unknown`` stays in the text columns and is NULL in the numbers."""
    return raw.select(
        parse.trim(F.col(MODEL)).alias(MODEL),
        parse.price_usd(F.col(PRICE)).alias(PRICE),
        parse.trim(F.col(BRAND)).alias(BRAND),
        parse.ram_gb(F.col(RAM)).alias(RAM),
        parse.clock_mhz(F.col(CLOCK)).alias(CLOCK),
        F.col(DATE),
    )


def batch_verdict(raw: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """Rows, bad cells and verdict per batch; one bad cell fails the whole batch.

    Without ``batch`` columns the frame is one batch and the result one row.
    """
    n_bad = [
        F.count_if(flag(F.col(name))).alias(f"bad_{label}")
        for label, name, flag in [
            ("price", PRICE, parse.bad_price),
            ("ram", RAM, parse.bad_ram),
            ("clock", CLOCK, parse.bad_clock),
        ]
    ]
    counted = raw.groupBy(*(batch or [])).agg(F.count(F.lit(1)).alias("n_rows"), *n_bad)
    return counted.withColumn("is_clean", F.expr("bad_price + bad_ram + bad_clock = 0"))


def stamp_date(offers: DataFrame, run_date: str) -> DataFrame:
    """The scrape date of a run on every row."""
    return offers.withColumn(DATE, F.lit(run_date).cast("date"))
