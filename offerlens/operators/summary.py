"""Counts of one load that add up: the funnel of all loads from their union, without their rows.

What the funnel asks of its first two scans are counts: of rows by brand and model, and of
eligible rows by brand, model, price and clock. Counts of loads add up to those of the table in any
order, so each load keeps its own, and an analysis after a new month reads the counts of old
months but none of their rows.
"""

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.operators.funnel import MIN_PRESENT, Funnel, drop_null_model, eligible_counts, min_present, null_missing
from offerlens.schema import BRAND, CLOCK, MODEL, PRICE
from offerlens.staging import stage

PAIRS = f"{BRAND} string, {MODEL} string, n_rows long, n long"
CELLS = f"{BRAND} string, {MODEL} string, {PRICE} double, {CLOCK} double, n long"


def pair_counts(offers: DataFrame, least: int = MIN_PRESENT) -> DataFrame:
    """Rows and eligible rows of a load by brand and model."""
    return eligible_counts(offers, least)


def cell_counts(offers: DataFrame, least: int = MIN_PRESENT) -> DataFrame:
    """Eligible rows of a load with a brand, by brand, model, price and clock."""
    eligible = min_present(drop_null_model(null_missing(offers)), least).where(F.col(BRAND).isNotNull())
    return eligible.groupBy(BRAND, MODEL, PRICE, CLOCK).agg(F.count(F.lit(1)).alias("n"))


class SummaryFunnel(Funnel):
    """The funnel of all loads from their counts: every step that keeps copies.

    Distinct offers need the rows themselves and are left to ``Funnel``. The number of
    values that a row must have is part of the counts.
    """

    def __init__(self, pairs: DataFrame, cells: DataFrame, **options):
        super().__init__(None, **options)
        self._all_pairs, self._all_cells = pairs, cells

    @cached_property
    def _pairs(self) -> DataFrame:
        added = self._all_pairs.groupBy(BRAND, MODEL).agg(F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"))
        return stage(added, "brand-model")

    @cached_property
    def popular(self) -> DataFrame:
        added = self._all_cells.where(self._is_popular()).groupBy(BRAND, PRICE, CLOCK).agg(F.sum("n").alias("n"))
        return stage(added, "popular")

    def _rows_where(self, keep):
        raise TypeError("counts of loads hold no rows; use Funnel on the table")

    def _distinct(self) -> list[DataFrame]:
        return []
