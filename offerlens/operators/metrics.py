"""Averages, shares and ratios behind the bar and pie charts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.schema import BRAND, CLOCK, MODEL, PRICE, RAM


def mean_price_by_model(unique: DataFrame) -> DataFrame:
    """Dearest model first."""
    return unique.groupBy(MODEL).agg(F.avg(PRICE).alias("price")).orderBy(F.desc("price"), MODEL)


def mean_price_by_brand(unique: DataFrame) -> DataFrame:
    """Unweighted mean over the models of a brand, cheapest brand first."""
    by_model = unique.groupBy(BRAND, MODEL).agg(F.avg(PRICE).alias("price"))
    return by_model.groupBy(BRAND).agg(F.avg("price").alias("price")).orderBy("price", BRAND)


def brand_share(weighted: DataFrame) -> DataFrame:
    """Rows per brand and their percentage of all rows with a brand."""
    per_brand = weighted.where(F.col(BRAND).isNotNull()).groupBy(BRAND).agg(F.sum("n").alias("n"))
    total = per_brand.agg(F.sum("n")).first()[0]
    return per_brand.withColumn("percent", F.col("n") * 100.0 / F.lit(total)).orderBy(F.desc("n"), BRAND)


def spec_means_by_model(unique: DataFrame) -> DataFrame:
    """Mean price, memory and clock per model, in model order."""
    return (
        unique.groupBy(MODEL)
        .agg(F.avg(PRICE).alias("price"), F.avg(RAM).alias("ram"), F.avg(CLOCK).alias("clock"))
        .orderBy(MODEL)
    )


def usd_per_gb(unique: DataFrame) -> DataFrame:
    """Mean price over mean memory per model; NULL where the memory mean is zero."""
    return _ratio_by_model(unique, F.try_divide("price", "ram"), "usd_per_gb")


def usd_per_100mhz(unique: DataFrame) -> DataFrame:
    """Mean price over mean clock, times 100, per model; NULL where the clock mean is zero."""
    return _ratio_by_model(unique, F.try_divide("price", "clock") * 100, "usd_per_100mhz")


def _ratio_by_model(unique: DataFrame, ratio: Column, name: str) -> DataFrame:
    return spec_means_by_model(unique).select(MODEL, ratio.alias(name)).orderBy(MODEL)
