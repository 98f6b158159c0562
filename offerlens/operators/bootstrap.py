"""Bootstrap intervals for the regression line and for category means.

Rows are drawn in one of two ways. ``multinomial`` draws exactly n of n, see there; the dashboard
does. ``poisson`` gives every row a Poisson(1) weight instead, with draws that another engine
can repeat number by number. Either way a draw depends only on the content of the row and on the
replicate number, so results do not change with the partitioning or when a lost task runs
again. The rest of this text is on Poisson weights.

Equal rows are counted first and resampled together, so the cost follows the number
of distinct (x, y) cells. A cell of n copies draws its Poisson(n) total exactly, as a
sum: n is written in base 16, and each unit of a digit draws from Poisson(1),
Poisson(16) or Poisson(256); higher digits are drawn in units of 256.
"""

from decimal import Decimal, localcontext
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.operators.distribution import all_categories
from offerlens.operators.multinomial import resampled_sums
from offerlens.schema import CLOCK, PRICE
from offerlens.staging import spread, stage, stage_observed

REPLICATES = 1000
GRID_POINTS = 100
INTERVAL = (0.025, 0.975)
DRAWS = ("poisson", "multinomial")
# Means of the draws that make up a total, by level.
MEANS = (1, 16, 256)

# A draw has two residues modulo this prime, 62 bits of state. Each goes x -> x^5, which
# permutes the residues (5 does not divide P - 1).
P = 2**31 - 1
_STRIDE = 1640531527


@cache
def poisson_bounds(mean: int) -> tuple[int, list[int]]:
    """(k, bounds): Poisson(mean) is k plus the number of bounds not above a uniform draw in [0, P * P).

    The bounds are the cumulative probabilities, as far as a draw can tell them from 0 and 1.
    """
    with localcontext() as context:
        context.prec = 60
        whole, term = Decimal(P) * P, (-Decimal(mean)).exp()
        total, k, bounds = term, 0, []
        while not bounds or bounds[-1] < P * P - 1 and term * whole > Decimal("1e-3") or k < mean:
            bounds.append(int(total * whole))
            k += 1
            term = term * mean / k
            total += term
    first = sum(bound == 0 for bound in bounds)
    return first, bounds[first:]


def _residue(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long") % P


def with_uniform(df: DataFrame, name: str, seed: str) -> DataFrame:
    """Adds a pseudo-random residue in [0, P) for a row seed and a ``replicate`` number."""
    # One column per step: the optimiser keeps a projection whose result is used twice.
    return (
        df.withColumn("_x", (F.col(seed) + F.col("replicate") * _STRIDE) % P)
        .withColumn("_square", F.col("_x") * F.col("_x") % P)
        .withColumn("_fourth", F.col("_square") * F.col("_square") % P)
        .withColumn(name, F.col("_fourth") * F.col("_x") % P)
        .drop("_x", "_square", "_fourth")
    )


def poisson(mean: int, u: Column) -> Column:
    """Poisson(mean) from a uniform draw in [0, P * P), by halving the list of bounds."""
    first, bounds = poisson_bounds(mean)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(first + low).cast("long")
        middle = (low + high) // 2
        return F.when(u < bounds[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(bounds))


def resample(cells: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """Adds ``replicate`` and ``weight``; ``cells`` hold distinct rows and their count ``n``.

    A cell gives several rows per replicate, one for each draw; its weight is their sum.
    Numbers enter the row key with six decimals.
    """
    values = [F.format_string("%.6f", c) if t == "double" else F.col(c).cast("string")
              for c, t in cells.dtypes if c != "n"]
    kept = [*cells.columns, "replicate", "weight"]
    drawn = None
    for level, mean in enumerate(MEANS):
        last = level == len(MEANS) - 1
        digit = F.floor(F.col("n") / mean) if last else F.floor(F.col("n") / mean) % MEANS[1]
        units = cells.withColumn("copies", digit).where("copies > 0")
        seeded = _seeded(units, values, level, replicates)
        uniform = with_uniform(with_uniform(seeded, "u", "seed"), "v", "seed2")
        weighed = uniform.withColumn("uv", F.col("u") * P + F.col("v")).withColumn("weight", poisson(mean, F.col("uv")))
        drawn = weighed.select(*kept) if drawn is None else drawn.unionByName(weighed.select(*kept))
    return drawn


def _seeded(units: DataFrame, values: list[Column], level: int, replicates: int) -> DataFrame:
    """One row per copy and replicate, with two residues that depend on content, level and copy."""
    kept = [c for c in units.columns if c != "copies"]
    keys = [c for c in kept if c != "n"]
    copied = spread(units, *keys).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    digest = F.md5(F.concat_ws("|", *values, F.lit(str(level)), F.col("copy").cast("string")))
    seeded = copied.withColumn("digest", digest).select(
        *kept, _residue(F.col("digest"), 1).alias("seed"), _residue(F.col("digest"), 16).alias("seed2")
    )
    return seeded.withColumn("replicate", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(replicates).cast("long"))))


def _cells(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _drawn_sums(
    cells: DataFrame, terms: dict[str, Column], replicates: int, draws: str, group: str | None = None
) -> DataFrame:
    """Sums of ``terms`` and ``n`` for each group and replicate; replicate 0 are the rows themselves."""
    if draws not in DRAWS:
        raise ValueError(f"draws must be one of {DRAWS}")
    drawn = cells.withColumns({"replicate": F.lit(0).cast("long"), "weight": F.col("n")})
    if draws == "poisson":
        drawn = resample(cells, replicates).unionByName(drawn)
    by = [group, "replicate"] if group else ["replicate"]
    sums = drawn.groupBy(*by).agg(
        F.sum("weight").alias("n"), *[F.sum(F.col("weight") * term).alias(name) for name, term in terms.items()]
    )
    return sums if draws == "poisson" else sums.unionByName(resampled_sums(cells, terms, replicates, group))


def _interval(value: Column) -> Column:
    """Array of the two ends."""
    return F.percentile(value, list(INTERVAL))


def _ends() -> list[Column]:
    return [F.get("ends", F.lit(i)).alias(name) for i, name in enumerate(("low", "high"))]


def price_clock_band(
    unique: DataFrame, replicates: int = REPLICATES, points: int = GRID_POINTS, draws: str = "poisson"
) -> DataFrame:
    """Fitted line and its 95% band on an even grid of clock values."""
    cells, seen = stage_observed(
        _cells(unique, CLOCK, PRICE),
        "pairs",
        F.min(CLOCK).alias("low"),
        F.max(CLOCK).alias("high"),
    )
    if seen["low"] is None:
        return unique.sparkSession.createDataFrame([], "point int, clock double, fit double, low double, high double")
    low, high = seen["low"], seen["high"]
    # Clocks are measured from the lowest, which keeps the squared sums small.
    dx, y = F.col(CLOCK) - F.lit(low), F.col(PRICE)
    sums = _drawn_sums(cells, {"sx": dx, "sy": y, "sxx": dx * dx, "sxy": dx * y}, replicates, draws)
    slope = F.expr("try_divide(n * sxy - sx * sy, n * sxx - sx * sx)")
    lines = sums.withColumn("slope", slope).withColumn("base", F.expr("try_divide(sy - slope * sx, n)"))
    step = (high - low) / (points - 1)
    at = F.when(F.col("point") == points - 1, F.lit(high)).otherwise(F.col("point") * step + low)
    grid = lines.select("replicate", "slope", "base", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    estimates = grid.withColumn("clock", at).withColumn("estimate", F.expr("base") + F.col("slope") * (F.col("clock") - low))
    banded = estimates.groupBy("point", "clock").agg(
        F.max(F.when(F.col("replicate") == 0, F.col("estimate"))).alias("fit"),
        _interval(F.when(F.col("replicate") > 0, F.col("estimate"))).alias("ends"),
    )
    return banded.select("point", "clock", "fit", *_ends()).orderBy("point")


def group_mean_ci(
    df: DataFrame, group: str, value: str, replicates: int = REPLICATES, draws: str = "poisson"
) -> DataFrame:
    """Mean of ``value`` per group with its 95% interval: group, ``n``, ``mean``, ``low``, ``high``."""
    cells = stage(_cells(df, group, value), "group-values")
    sums = _drawn_sums(cells, {"total": F.col(value)}, replicates, draws, group)
    means = sums.select(group, "replicate", "n", F.try_divide("total", "n").alias("mean"))
    original = F.col("replicate") == 0
    found = means.groupBy(group).agg(
        F.max(F.when(original, F.col("n"))).alias("n"),
        F.max(F.when(original, F.col("mean"))).alias("mean"),
        _interval(F.when(~original, F.col("mean"))).alias("ends"),
    )
    return found.select(group, "n", "mean", *_ends())


def price_by_category_ci(categorised: DataFrame, replicates: int = REPLICATES, draws: str = "poisson") -> DataFrame:
    """Mean price per category with its 95% interval, in category order."""
    found = group_mean_ci(categorised, "category_no", PRICE, replicates, draws).withColumnRenamed("mean", "price")
    return (
        all_categories(categorised)
        .join(found, "category_no", "left")
        .select("category_no", "category", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "price", "low", "high")
        .orderBy("category_no")
    )
