"""The analysis funnel: missing values, most common brands and models, outlier fences.

Every step needs a number about the whole frame that the step before left over.
Those numbers are few and bounded (k keys, two fences), so they are fetched and
become literals of the next filter. Two scans find them all: one counts (brand,
model), one counts (brand, price, clock) of the popular models. Statistics that
keep copies read the second count; the rows themselves are a third scan with every
filter pushed into it.
"""

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.parse import nan_to_null, sentinel_to_null
from offerlens.operators.quantiles import exact_quantiles
from offerlens.schema import BRAND, CLOCK, MODEL, OFFER_COLUMNS, PRICE, RAM
from offerlens.staging import stage

# Fixed values of the analysis.
TOP_BRANDS = 10
TOP_MODELS = 15
MIN_PRESENT = 3
WHISKER = 1.5


def null_missing(offers: DataFrame) -> DataFrame:
    """The six columns with every missing value, sentinel or NaN, as NULL."""
    numbers = (PRICE, RAM, CLOCK)
    return offers.select(
        *[
            (nan_to_null(F.col(c)) if c in numbers else sentinel_to_null(F.col(c)) if c in (MODEL, BRAND) else F.col(c)).alias(c)
            for c in OFFER_COLUMNS
        ]
    )


def drop_null_model(offers: DataFrame) -> DataFrame:
    return offers.na.drop(subset=[MODEL])


def min_present(offers: DataFrame, least: int = MIN_PRESENT) -> DataFrame:
    """Rows with at least ``least`` of the six values present."""
    return offers.na.drop(thresh=least, subset=OFFER_COLUMNS)


def _has_min_present(least: int = MIN_PRESENT) -> Column:
    return sum(F.col(c).isNotNull().cast("int") for c in OFFER_COLUMNS) >= least


def key_counts(offers: DataFrame, key: str) -> DataFrame:
    """Rows per key, most frequent first, missing keys left out; ties by key."""
    counted = offers.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), key)


def top_keys(counts: DataFrame, key: str, k: int) -> list[str]:
    """The k most frequent keys of ``counts(key, n)``; ties by key."""
    return [row[key] for row in counts.orderBy(F.desc("n"), key).limit(k).collect()]


@dataclass(frozen=True)
class Fence:
    """Open interval; without rows to take quartiles from, nothing lies inside."""

    q1: float | None
    q3: float | None
    whisker: float = WHISKER

    @property
    def low(self) -> float:
        return self.q1 - (self.q3 - self.q1) * self.whisker

    @property
    def high(self) -> float:
        return self.q3 + (self.q3 - self.q1) * self.whisker

    def holds(self, column: str) -> Column:
        if self.q1 is None:
            return F.lit(False)
        return (F.col(column) < self.high) & (F.col(column) > self.low)


def eligible_counts(offers: DataFrame, least: int = MIN_PRESENT) -> DataFrame:
    """(brand, model) with all rows in ``n_rows`` and the eligible ones in ``n``."""
    return null_missing(offers).groupBy(BRAND, MODEL).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(MODEL).isNotNull() & _has_min_present(least)).alias("n"),
    )


class Funnel:
    """The staged funnel over an offers frame, each step computed once on first use."""

    def __init__(
        self,
        offers: DataFrame | None,
        top_brands: int = TOP_BRANDS,
        top_models: int = TOP_MODELS,
        least_present: int = MIN_PRESENT,
        whisker: float = WHISKER,
    ):
        self.offers = offers and offers.select(*OFFER_COLUMNS)
        self._k_brands = top_brands
        self._k_models = top_models
        self._least = least_present
        self._whisker = whisker

    @cached_property
    def _pairs(self) -> DataFrame:
        """(brand, model) with all rows and the eligible ones; the first scan."""
        return stage(eligible_counts(self.offers, self._least), "brand-model")

    @cached_property
    def brands(self) -> list[str]:
        return top_keys(self.brand_counts(), BRAND, self._k_brands)

    @cached_property
    def models(self) -> list[str]:
        """Counted among the offers of the top brands."""
        return top_keys(self.model_counts(), MODEL, self._k_models)

    def brand_counts(self) -> DataFrame:
        pairs = self._pairs.where(F.col(BRAND).isNotNull() & (F.col("n") > 0))
        return pairs.groupBy(BRAND).agg(F.sum("n").alias("n"))

    def model_counts(self) -> DataFrame:
        pairs = self._pairs.where(F.col(BRAND).isin(self.brands) & F.col(MODEL).isNotNull() & (F.col("n") > 0))
        return pairs.groupBy(MODEL).agg(F.sum("n").alias("n"))

    def eligible(self) -> DataFrame:
        return min_present(drop_null_model(null_missing(self.offers)), self._least)

    def of_top_brands(self) -> DataFrame:
        return self._rows_where(F.col(BRAND).isin(self.brands))

    def of_top_models(self) -> DataFrame:
        return self._rows_where(self._is_popular())

    def _is_popular(self) -> Column:
        return F.col(BRAND).isin(self.brands) & F.col(MODEL).isin(self.models)

    def _rows_where(self, keep: Column) -> DataFrame:
        # Filters that compare stored columns with literals reach the scan. None of
        # them holds for a sentinel or for NaN, so they may come before null_missing.
        return min_present(drop_null_model(null_missing(self.offers.where(keep))), self._least)

    @cached_property
    def popular(self) -> DataFrame:
        """Rows of the top models counted by brand, price and clock; the second scan."""
        counted = self.of_top_models().groupBy(BRAND, PRICE, CLOCK).agg(F.count(F.lit(1)).alias("n"))
        return stage(counted, "popular")

    @cached_property
    def price_fence(self) -> Fence:
        quartiles = exact_quantiles(self.popular, PRICE, [0.25, 0.75], F.col("n"))
        return Fence(*quartiles, self._whisker)

    @cached_property
    def clock_fence(self) -> Fence:
        """Taken after the price fence."""
        inside = self.popular.where(self.price_fence.holds(PRICE))
        quartiles = exact_quantiles(inside, CLOCK, [0.25, 0.75], F.col("n"))
        return Fence(*quartiles, self._whisker)

    def inside_price(self) -> DataFrame:
        """Rows, copies included, after the price fence."""
        return self._rows_where(self._is_popular() & self.price_fence.holds(PRICE))

    def _in_fences(self) -> Column:
        return self.price_fence.holds(PRICE) & self.clock_fence.holds(CLOCK)

    def rows(self) -> DataFrame:
        """Rows, copies included, after the whole funnel."""
        return self._rows_where(self._is_popular() & self._in_fences())

    def weighted(self) -> DataFrame:
        """The same rows counted by brand, price and clock, with the count ``n``.

        Enough for every statistic that keeps copies, at a fraction of the rows.
        """
        return self.popular.where(self._in_fences())

    def unique(self) -> DataFrame:
        """The distinct rows; stage it where more than one step reads it."""
        return self.rows().distinct()

    def _one_rows(self) -> list[DataFrame]:
        """Rows left after each step, in order, as columns of one-row frames."""
        pairs = self._pairs.agg(
            F.sum("n_rows").alias("raw"),
            F.sum(F.when(F.col(MODEL).isNotNull(), F.col("n_rows"))).alias("model_present"),
            F.sum("n").alias("min_present"),
            F.sum(F.when(F.col(BRAND).isin(self.brands), F.col("n"))).alias("top_brands"),
        )
        in_price = self.price_fence.holds(PRICE)
        popular = self.popular.agg(
            F.sum("n").alias("top_models"),
            F.sum(F.when(F.col(PRICE).isNotNull(), F.col("n"))).alias("price_present"),
            F.sum(F.when(in_price, F.col("n"))).alias("price_fence"),
            F.sum(F.when(in_price & F.col(CLOCK).isNotNull(), F.col("n"))).alias("clock_present"),
            F.sum(F.when(self._in_fences(), F.col("n"))).alias("clock_fence"),
        )
        return [pairs, popular, *self._distinct()]

    def _distinct(self) -> list[DataFrame]:
        return [self.unique().agg(F.count(F.lit(1)).alias("distinct"))]

    def counts(self) -> DataFrame:
        """Rows left after each step, in order."""
        first = 0
        steps = []
        for one_row in self._one_rows():
            steps.append(_numbered_steps(one_row, first))
            first += len(one_row.columns)
        return reduce(DataFrame.unionByName, steps)


def _numbered_steps(one_row: DataFrame, first: int) -> DataFrame:
    steps = [
        F.struct(F.lit(first + i).alias("step"), F.lit(c).alias("stage"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n"))
        for i, c in enumerate(one_row.columns)
    ]
    return one_row.select(F.inline(F.array(*steps)))
