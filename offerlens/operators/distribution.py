"""Equal-width bins, box statistics, histogram, density and linear fit.

Frame-wide numbers (minimum, maximum, spread) are one row each. They are fetched
and become literals, so every series below is a single aggregation without a join.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.operators.quantiles import exact_quantiles, value_counts
from offerlens.schema import CLOCK, PRICE
from offerlens.staging import spread, stage

# Fixed values of the charts.
CATEGORY_LABELS = ["very low", "low", "moderate", "high"]
HISTOGRAM_BINS = 7
DENSITY_POINTS = 200
BOX_WHISKER = 1.5


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    low, high = df.agg(F.min(column), F.max(column)).first()
    return None if low is None else (low, high)


def edges(low: float, high: float, bins: int) -> list[float]:
    """``bins + 1`` evenly spaced edges; the last is exactly ``high``."""
    step = (high - low) / bins
    return [i * step + low for i in range(bins)] + [high]


def clock_category(clock: Column, limits: tuple[float, float] | None, include_lowest: bool = False) -> Column:
    """Ordinal 0..3 of the right-closed interval that holds ``clock``.

    The lowest value itself has no category unless ``include_lowest``; where all
    clocks are equal there are no intervals, hence no categories.
    """
    if limits is None or limits[0] == limits[1]:
        return F.lit(None).cast("int")
    cuts = edges(*limits, len(CATEGORY_LABELS))
    above = clock >= cuts[0] if include_lowest else clock > cuts[0]
    chosen = F.when(~above, F.lit(None).cast("int"))
    for ordinal, cut in enumerate(cuts[1:]):
        chosen = chosen.when(clock <= cut, ordinal)
    return chosen


def category_label(ordinal: Column) -> Column:
    return F.get(F.array(*[F.lit(label) for label in CATEGORY_LABELS]), ordinal)


def with_clock_category(unique: DataFrame, limits: tuple[float, float] | None, include_lowest: bool = False) -> DataFrame:
    """Adds ``category_no`` and ``category``; ``limits`` come from the rows with copies."""
    numbered = unique.withColumn("category_no", clock_category(F.col(CLOCK), limits, include_lowest))
    return numbered.withColumn("category", category_label(F.col("category_no")))


def all_categories(df: DataFrame) -> DataFrame:
    """The four categories in order, as a frame on the session of ``df``."""
    number = F.col("id").cast("int")
    rows = df.sparkSession.range(0, len(CATEGORY_LABELS), 1, 1)
    return rows.select(number.alias("category_no"), category_label(number).alias("category"))


def mean_price_by_category(categorised: DataFrame) -> DataFrame:
    """One row per category, also for empty ones, in category order."""
    means = (
        categorised.where(F.col("category_no").isNotNull())
        .groupBy("category_no")
        .agg(F.count(PRICE).alias("n"), F.avg(PRICE).alias("price"))
    )
    spine = all_categories(categorised)
    return (
        spine.join(means, "category_no", "left")
        .select("category_no", "category", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "price")
        .orderBy("category_no")
    )


def price_clock_fit(unique: DataFrame) -> DataFrame:
    """Least squares line of price on clock over rows that have both."""
    y, x = F.col(PRICE), F.col(CLOCK)
    return unique.agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def box_stats(weighted: DataFrame, column: str = PRICE, whisker: float = BOX_WHISKER) -> DataFrame:
    """Quartiles, whiskers (extremes within the fences, inclusive) and outliers."""
    q1, median, q3 = exact_quantiles(weighted, column, [0.25, 0.5, 0.75], F.col("n"))
    value, number = F.col(column), "double"
    q1, median, q3 = (F.lit(q).cast(number) for q in (q1, median, q3))
    reach = (q3 - q1) * whisker
    extremes = weighted.where(value.isNotNull()).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"),
        F.max(F.when(value <= q3 + reach, value)).alias("top"),
        F.min(F.when(value >= q1 - reach, value)).alias("bottom"),
        F.sum(F.when((value > q3 + reach) | (value < q1 - reach), F.col("n"))).alias("outside"),
    )
    return extremes.select(
        "n",
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        # A whisker never ends inside the box.
        F.least("bottom", q1).alias("whisker_low"),
        F.greatest("top", q3).alias("whisker_high"),
        F.coalesce("outside", F.lit(0).cast("long")).alias("n_outliers"),
    )


def box_outliers(weighted: DataFrame, column: str = PRICE, whisker: float = BOX_WHISKER) -> DataFrame:
    """The outlying values with their copies."""
    q1, q3 = exact_quantiles(weighted, column, [0.25, 0.75], F.col("n"))
    if q1 is None:
        return value_counts(weighted, column, F.col("n"))
    reach = (q3 - q1) * whisker
    outside = weighted.where((F.col(column) > q3 + reach) | (F.col(column) < q1 - reach))
    return value_counts(outside, column, F.col("n")).orderBy(column)


def histogram(weighted: DataFrame, column: str = PRICE, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins over [min, max]; the last bin holds the maximum."""
    limits = value_range(weighted, column)
    spark = weighted.sparkSession
    if limits is None:
        return spark.createDataFrame([], "bin int, bin_low double, bin_high double, n long")
    low, high = limits
    if low == high:
        low, high = low - 0.5, high + 0.5
    cuts = edges(low, high, bins)
    number, all_cuts = F.col("id").cast("int"), F.array(*[F.lit(cut) for cut in cuts])
    spine = spark.range(0, bins, 1, 1).select(
        number.alias("bin"), F.get(all_cuts, number).alias("bin_low"), F.get(all_cuts, number + 1).alias("bin_high")
    )
    chosen = F.when(F.col(column) < cuts[1], 0)
    for i, cut in enumerate(cuts[2:-1], start=1):
        chosen = chosen.when(F.col(column) < cut, i)
    counted = (
        weighted.where(F.col(column).isNotNull())
        .groupBy(chosen.otherwise(bins - 1).alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    return (
        spine.join(counted, "bin", "left")
        .select("bin", "bin_low", "bin_high", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
        .orderBy("bin")
    )


@dataclass(frozen=True)
class Moments:
    n: int
    low: float
    high: float
    stddev: float


def _moments(counts: DataFrame, column: str) -> Moments | None:
    """Moments of counted values, centred before squaring."""
    value, n = F.col(column), F.col("n")
    total, low, high, mean = counts.agg(
        F.sum(n), F.min(value), F.max(value), F.sum(value * n) / F.sum(n)
    ).first()
    if total is None or total < 2 or low == high:
        return None
    squares = counts.agg(F.sum(F.pow(value - mean, 2) * n)).first()[0]
    return Moments(total, low, high, math.sqrt(squares / (total - 1)))


#: Terms of the expansion, and half the width of a cell in bandwidths. A value of a cell is off by at most
#: exp(-p/2) * p**(p/2) * a**p / p! = 2e-17 of one kernel, whatever the distance (p terms, half width a).
TERMS, HALF_CELL = 16, 0.25


def density(
    weighted: DataFrame, column: str = PRICE, points: int = DENSITY_POINTS, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max], also scaled to counts.

    The bandwidth h follows Scott's rule. Sums of kernels come from a fast Gauss transform:
    around the centre c of a cell, with s = (x - c) / h and u = (value - c) / h, a kernel is
    exp(-s*s/2) * exp(-u*u/2) * exp(s*u), and the last factor a power series in s. So the values of a
    cell are summed into ``TERMS`` moments once, and the grid meets cells instead of values. Cells
    are half a bandwidth wide, which is what bounds their number.
    """
    counts = stage(value_counts(weighted, column, F.col("n")), "value-counts")
    moments = _moments(counts, column)
    if moments is None:
        return weighted.sparkSession.createDataFrame([], "point int, x double, density double, count_scaled double")
    width = moments.stddev * moments.n ** -0.2
    step = (moments.high - moments.low) / (points - 1)
    grid = F.when(F.col("point") == points - 1, F.lit(moments.high)).otherwise(F.col("point") * step + moments.low)
    cells = stage(_cell_moments(counts, column, moments.low, width), "kernel-cells")
    at_points = spread(cells, "cell").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    placed = at_points.withColumn("x", grid).withColumn("s", (F.col("x") - F.col("centre")) / width)
    series = F.lit(0.0)
    for k in reversed(range(TERMS)):
        series = series * F.col("s") + F.col(f"m{k}")
    summed = placed.groupBy("point", "x").agg(F.sum(F.exp(-0.5 * F.col("s") * F.col("s")) * series).alias("mass"))
    height = F.col("mass") / (moments.n * width * math.sqrt(2 * math.pi))
    bin_width = (moments.high - moments.low) / bins
    return summed.select(
        "point", "x", height.alias("density"), (height * (moments.n * bin_width)).alias("count_scaled")
    ).orderBy("point")


def _cell_moments(counts: DataFrame, column: str, low: float, width: float) -> DataFrame:
    """(cell, centre, m0, m1, ...): of the values of each cell, the sums that its part of any density needs."""
    side = 2 * HALF_CELL * width
    placed = counts.withColumn("cell", F.floor((F.col(column) - low) / side))
    centred = placed.withColumn("centre", (F.col("cell") + 0.5) * side + low)
    scaled = centred.withColumn("u", (F.col(column) - F.col("centre")) / width)
    weight = scaled.withColumn("w", F.exp(-0.5 * F.col("u") * F.col("u")) * F.col("n"))
    sums = [F.sum(F.col("w") * F.pow("u", F.lit(k)) / math.factorial(k)).alias(f"m{k}") for k in range(TERMS)]
    return weight.groupBy("cell", "centre").agg(*sums)
