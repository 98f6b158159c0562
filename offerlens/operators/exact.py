"""Sums, means and fits of doubles that do not depend on the order of rows.

A double is a mantissa times a power of two. Cut at fixed powers of 2^24 it gives at most
four whole digits, and digits of one place add up as whole numbers, exactly and in any
order. So a sum is the same to the last bit under any partitioning, after any lost task, and
it is the true sum rounded once. What is shuffled is at most ``PLACES`` digits a group and task.

A group may have up to 2^39 rows, copies counted; beyond that the whole-number sum may raise an
overflow error, never a wrong result. Missing values are left out. A sum with NaN, or with both
infinities, is NaN; with one of them it is that infinity.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.doubles import FRACTION, LEAST, exponent, mantissa
from offerlens.schema import BRAND, CLOCK, MODEL, PRICE, RAM

DIGIT = 24
_BASE = 1 << DIGIT
#: Power of two of the lowest bit of any double, and the digits that the largest one spans, with room for sums.
_LOWEST = LEAST - FRACTION
PLACES = (1023 - _LOWEST) // DIGIT + 3
#: Places of what is not a digit: number of values, NaN, infinities.
_COUNT, _NAN, _PLUS, _MINUS = -1, -2, -3, -4


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, each evaluated once: a generator keeps the optimiser from copying them into their readers."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _cut(values: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, term, place, digit) of each value: its count, up to four digits, or what stands for a number that is not finite."""

    def each(make) -> dict[str, Column]:
        return {f"__{part}_{name}": c for name in names for part, c in make(name, lambda p, n=name: F.col(f"__{p}_{n}")).items()}

    def kind(name: str, at) -> dict[str, Column]:
        value = F.col(f"__{name}")
        special = F.when(F.isnan(value), _NAN).when(value == float("inf"), _PLUS).when(value == -float("inf"), _MINUS)
        some = F.when(value.isNull() | special.isNotNull(), 0.0).otherwise(value)
        return {"special": special, "some": some, "power": exponent(some)}

    def whole(name: str, at) -> dict[str, Column]:
        raised = at("power") - F.lit(FRACTION + _LOWEST)
        return {"whole": mantissa(at("some"), at("power")), "place": F.floor(raised / DIGIT).cast("int"), "shift": raised % DIGIT}

    def halves(name: str, at) -> dict[str, Column]:
        low = F.call_function("shiftleft", at("whole").bitwiseAND(F.lit((1 << 32) - 1)), at("shift"))
        high = F.call_function("shiftleft", F.shiftright(at("whole"), 32), at("shift"))
        return {"low": low, "rest": F.shiftright(low, DIGIT) + F.shiftleft(high, 32 - DIGIT)}

    for step in (kind, whole, halves):
        values = _once(values, each(step))
    mask, times = F.lit(_BASE - 1), F.col("__times")
    entries = []
    for term, name in enumerate(names):
        low, rest, some, place, special = (F.col(f"__{part}_{name}") for part in ("low", "rest", "some", "place", "special"))
        signed = F.when(some < 0, -times).otherwise(times)
        parts = [low.bitwiseAND(mask), rest.bitwiseAND(mask), F.shiftright(rest, DIGIT).bitwiseAND(mask), F.shiftright(rest, 2 * DIGIT)]
        found = [
            (F.lit(_COUNT), F.when(F.col(f"__{name}").isNull(), F.lit(0)).otherwise(times)),
            (F.coalesce(special, F.lit(_NAN)), F.when(special.isNull(), F.lit(0)).otherwise(times)),
            *[(place + k, part * signed) for k, part in enumerate(parts)],
        ]
        entries += [
            F.struct(F.lit(term).alias("term"), at.cast("int").alias("place"), digit.cast("long").alias("digit")) for at, digit in found
        ]
    return values.select(*keys, F.inline(F.array(*entries))).where((F.col("digit") != 0) | (F.col("place") == _COUNT))


def _carried(digits: Column, sign: int) -> Column:
    """(carry, digits from 0 to 2^24 - 1), of the sum or of its opposite; the carry is negative if the sum is."""

    def step(state: Column, digit: Column) -> Column:
        total = state["carry"] + digit * sign
        return F.struct(
            F.shiftright(total, DIGIT).alias("carry"),
            F.concat(state["digits"], F.array(total.bitwiseAND(F.lit(_BASE - 1)))).alias("digits"),
        )

    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits"))
    return F.aggregate(digits, start, step)


def _rounded_once(digits: Column, first: Column) -> Column:
    """The double nearest to a sum of digits that are not negative, zero from ``first`` + 4 on."""
    # Four digits hold 73 bits or more, all that a double can; of what is below only counts whether it is zero.
    exact = "decimal(38,0)"
    window = F.lit(0).cast("decimal(31,0)")
    for k in (3, 2, 1, 0):
        window = (window * F.lit(_BASE).cast("decimal(8,0)") + F.get(digits, first + k).cast("decimal(8,0)")).cast("decimal(31,0)")
    below = F.exists(F.slice(digits, F.lit(1), first), lambda d: d != 0)
    twice = (window.cast(exact) * 2 + below.cast("int")).cast(exact).cast("double")
    power = first * DIGIT + F.lit(_LOWEST - 1)
    half = F.floor(power / 2)  # 2^power itself may be below the least double
    return twice * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _summed(gathered: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds each term's sum, and its number of values, to a frame with ``__entries``."""

    def each(make) -> dict[str, Column]:
        return {k: c for i, name in enumerate(names) for k, c in make(i, name).items()}

    def entries(i: int, name: str) -> dict[str, Column]:
        mine = F.filter(F.col("__entries"), lambda e: e["term"] == i)
        return {f"__map_{name}": F.map_from_entries(F.transform(mine, lambda e: F.struct(e["place"], e["digit"])))}

    def digit(name: str, place: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(f"__map_{name}"), place), F.lit(0).cast("long"))

    def dense(i: int, name: str) -> dict[str, Column]:
        return {f"__dense_{name}": F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda place: digit(name, place))}

    def carried(sign: int):
        return lambda i, name: {f"__carried_{sign}_{name}": _carried(F.col(f"__dense_{name}"), sign)}

    def size(i: int, name: str) -> dict[str, Column]:
        up, down = F.col(f"__carried_1_{name}"), F.col(f"__carried_-1_{name}")
        return {f"__minus_{name}": up["carry"] < 0, f"__size_{name}": F.when(up["carry"] < 0, down["digits"]).otherwise(up["digits"])}

    def first(i: int, name: str) -> dict[str, Column]:
        top = F.array_max(F.transform(F.col(f"__size_{name}"), lambda d, at: F.when(d != 0, at).otherwise(0)))
        return {f"__first_{name}": F.greatest(top - 3, F.lit(0))}

    def total(i: int, name: str) -> dict[str, Column]:
        size = _rounded_once(F.col(f"__size_{name}"), F.col(f"__first_{name}"))
        nan, plus, minus, n = (digit(name, F.lit(p)) for p in (_NAN, _PLUS, _MINUS, _COUNT))
        value = (
            F.when(n == 0, F.lit(None).cast("double"))
            .when((nan != 0) | ((plus != 0) & (minus != 0)), F.lit(float("nan")))
            .when(plus != 0, F.lit(float("inf"))).when(minus != 0, F.lit(-float("inf")))
            .otherwise(F.when(F.col(f"__minus_{name}"), -size).otherwise(size))
        )
        return {name: value, f"n_{name}": n}

    for step in (entries, dense, carried(1), carried(-1), size, first, total):
        gathered = _once(gathered, each(step))
    return gathered


def exact_sums(df: DataFrame, keys: Sequence[str], terms: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """One row per group: of each term its sum, and ``n_<term>``, the number of its values.

    Each row counts ``weight`` times, a whole number. Without keys there is one row, also for an empty table.
    """
    times = F.lit(1).cast("long") if weight is None else weight.cast("long")
    values = df.select(*keys, times.alias("__times"), *[v.cast("double").alias(f"__{name}") for name, v in terms.items()])
    added = _cut(values, keys, list(terms)).groupBy(*keys, "term", "place").agg(F.sum("digit").alias("digit"))
    # At most PLACES + 4 entries a term.
    gathered = added.groupBy(*keys).agg(F.collect_list(F.struct("term", "place", "digit")).alias("__entries"))
    return _summed(gathered, list(terms)).select(*keys, *[c for name in terms for c in (name, f"n_{name}")])


def exact_means(df: DataFrame, keys: Sequence[str], terms: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """One row per group with the mean of each term, missing where it has no values."""
    means = [F.try_divide(F.col(name), F.col(f"n_{name}")).alias(name) for name in terms]
    return exact_sums(df, keys, terms, weight).select(*keys, *means)


def mean_price_by_model(unique: DataFrame) -> DataFrame:
    """Dearest model first."""
    return exact_means(unique, [MODEL], {"price": F.col(PRICE)}).orderBy(F.desc("price"), MODEL)


def mean_price_by_brand(unique: DataFrame) -> DataFrame:
    """Unweighted mean over the models of a brand, cheapest brand first."""
    by_model = exact_means(unique, [BRAND, MODEL], {"price": F.col(PRICE)})
    return exact_means(by_model, [BRAND], {"price": F.col("price")}).orderBy("price", BRAND)


def spec_means_by_model(unique: DataFrame) -> DataFrame:
    """Mean price, memory and clock per model, in model order."""
    return exact_means(unique, [MODEL], {"price": F.col(PRICE), "ram": F.col(RAM), "clock": F.col(CLOCK)}).orderBy(MODEL)


def line_fit(df: DataFrame, x: str, y: str, weight: Column | None = None) -> DataFrame:
    """Least squares line of ``y`` on ``x`` over rows that have both: n, slope, intercept, r2.

    One pass for the means, a second for the squares around them; each row's products do not depend
    on other rows, and their sums are exact.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    mid = exact_means(both, [], {"x": F.col(x), "y": F.col(y)}, weight).first()
    dx, dy = F.col(x) - F.lit(mid["x"]).cast("double"), F.col(y) - F.lit(mid["y"]).cast("double")
    sums = exact_sums(both, [], {"xx": dx * dx, "xy": dx * dy, "yy": dy * dy}, weight)
    slope = F.try_divide(F.col("xy"), F.col("xx"))
    r2 = F.when(F.col("xx") == 0, F.lit(None)).when(F.col("yy") == 0, 1.0).otherwise(F.col("xy") / F.col("xx") * (F.col("xy") / F.col("yy")))
    return sums.select(
        F.col("n_xx").alias("n"), slope.alias("slope"),
        (F.lit(mid["y"]).cast("double") - slope * F.lit(mid["x"]).cast("double")).alias("intercept"), r2.cast("double").alias("r2"),
    )


def price_clock_fit(unique: DataFrame) -> DataFrame:
    return line_fit(unique, CLOCK, PRICE)
