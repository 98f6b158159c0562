"""Offers stored so that the filters of the funnel can skip: by a curve over price and clock, with Bloom filters.

Each of the two numbers is replaced by the slice of its distribution that it lies in, and the bits of
both slices are interleaved (Z-order). Rows are written in the order of that curve within their date, so a file, and a
row group or page of one, covers a small rectangle of prices and clocks, and its minima and maxima
exclude it from most fences. Bloom filters exclude row groups without a wanted brand or model.

The order is one of storage only: what is read is the same. Missing numbers come first.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.schema import BRAND, CLOCK, DATE, MODEL, OFFER_COLUMNS, PRICE

#: Slices of each number, as a power of two, and the accuracy of their bounds.
BITS, ACCURACY = 6, 10_000
SORTED_BY = (PRICE, CLOCK)
FILTERED_BY = (BRAND, MODEL)


def slice_bounds(df: DataFrame, columns: tuple[str, ...] = SORTED_BY, bits: int = BITS) -> dict[str, list[float]]:
    """Approximate bounds that cut each column into equally many rows; NaN and missing values are left out."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [F.when(~F.isnan(c), F.col(c)) for c in columns]
    row = df.agg(*[F.percentile_approx(n, shares, ACCURACY).alias(c) for n, c in zip(numbers, columns, strict=True)]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def _slice(column: str, bounds: list[float]) -> Column:
    """Number of bounds below the value: zero for missing ones."""
    if not bounds:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda bound: bound < F.col(column))
    return F.when(F.col(column).isNull(), 0).otherwise(F.size(below))


def curve_place(bounds: dict[str, list[float]], bits: int = BITS) -> Column:
    """The place of a row on the curve: the bits of its slices, those of the columns in turn."""
    slices = [_slice(column, found) for column, found in bounds.items()]
    n = len(slices)
    parts = [
        F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), bit * n + n - 1 - k)
        for k, part in enumerate(slices) for bit in range(bits)
    ]
    return reduce(lambda a, b: a + b, parts)


def append_arranged(batch: DataFrame, table_path: str, row_group_bytes: int | None = None) -> None:
    """Append a batch in the order of the curve within dates; the table is made when missing.

    Rows are range-partitioned, equal places by the partition that they come from, so that a hot price or
    many copies of an offer are split over tasks like any others.
    """
    rows = batch.select(*OFFER_COLUMNS)
    placed = rows.withColumns({"__place": curve_place(slice_bounds(rows)), "__from": F.spark_partition_id()})
    order = [DATE, "__place", "__from"]
    arranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__place", "__from")
    writer = arranged.write.mode("append").partitionBy(DATE)
    # Adaptive filters take the size that the values of a row group need.
    filters = {"parquet.bloom.filter.adaptive.enabled": "true"}
    writer = writer.options(**filters, **{f"parquet.bloom.filter.enabled#{c}": "true" for c in FILTERED_BY})
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(table_path)
