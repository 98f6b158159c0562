"""All series of the price dashboard."""

from pyspark.sql import DataFrame

from offerlens.operators import bootstrap, distribution, metrics
from offerlens.operators.funnel import Funnel
from offerlens.schema import CLOCK
from offerlens.staging import stage


def dashboard(offers: DataFrame, replicates: int = bootstrap.REPLICATES) -> dict[str, DataFrame]:
    """One frame per chart; the funnel behind them is computed once and shared."""
    funnel = Funnel(offers)
    unique, weighted = stage(funnel.unique(), "unique"), funnel.weighted()
    categorised = distribution.with_clock_category(unique, distribution.value_range(weighted, CLOCK))
    return {
        "price_by_model": metrics.mean_price_by_model(unique),
        "price_by_brand": metrics.mean_price_by_brand(unique),
        "brand_share": metrics.brand_share(weighted),
        "usd_per_gb": metrics.usd_per_gb(unique),
        "usd_per_100mhz": metrics.usd_per_100mhz(unique),
        "price_clock_fit": distribution.price_clock_fit(unique),
        "price_clock_band": bootstrap.price_clock_band(unique, replicates, draws="multinomial"),
        "price_by_category": bootstrap.price_by_category_ci(categorised, replicates, "multinomial"),
        "price_box": distribution.box_stats(weighted),
        "price_box_outliers": distribution.box_outliers(weighted),
        "price_histogram": distribution.histogram(weighted),
        "price_density": distribution.density(weighted),
    }


def save_dashboard(series: dict[str, DataFrame], folder: str, source: str = "parquet") -> None:
    for name, frame in series.items():
        frame.write.mode("overwrite").format(source).save(f"{folder}/{name}")
