"""Appending batches to the offer table, the quarantine table and the CSV fallback."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from offerlens.schema import DATE, OFFER_COLUMNS
from offerlens.sources.layout import append_arranged
from offerlens.sources.offers import CSV_TEXT, read_offers, read_offers_jdbc
from offerlens.staging import folder_names

QUARANTINE_SUFFIX = "_uncleaned"
#: Dates of one load that get folders of their own.
MOST_FOLDERS = 100


def append_offers(batch: DataFrame, table_path: str, one_date: bool = False) -> None:
    """Append a batch; the table is made when missing.

    The rows of a single run carry one date and are written where they are. A batch
    of many dates is rebalanced first, or every task would write a file per date:
    small dates then share a task and a large one is split over several.

    A table has a folder for each date, unless the load that makes it has more than ``MOST_FOLDERS``
    dates. Such a load would make as many tiny files, which each scan lists and opens; its table has
    plain files, as many as its volume asks for, with the rows in the order of their dates, so that
    pages of other dates are skipped. A table keeps the form that it was made in.
    """
    rows = batch.select(*OFFER_COLUMNS)
    spread = rows if one_date else rows.hint("rebalance", DATE)
    if _has_date_folders(rows, table_path, one_date):
        return spread.write.mode("append").partitionBy(DATE).parquet(table_path)
    spread.sortWithinPartitions(DATE).write.mode("append").parquet(table_path)


def _has_date_folders(rows: DataFrame, table_path: str, one_date: bool) -> bool:
    names = folder_names(rows.sparkSession, table_path)
    if any(name.startswith(f"{DATE}=") for name in names):
        return True
    if any(not name.startswith(("_", ".")) for name in names):
        return False
    return one_date or rows.select(DATE).distinct().limit(MOST_FOLDERS + 1).count() <= MOST_FOLDERS


def append_jdbc(batch: DataFrame, url: str, table: str, **options: str) -> None:
    writer = batch.select(*OFFER_COLUMNS).write.format("jdbc").mode("append")
    writer.option("url", url).option("dbtable", table).options(**options).save()


def append_csv(batch: DataFrame, folder: str) -> None:
    """Texts as they are; missing values as ``NaN``. Every part file has its own header line."""
    writer = batch.select(*OFFER_COLUMNS).write.mode("append")
    writer.options(header=True, nullValue="NaN", **CSV_TEXT).csv(folder)


@dataclass(frozen=True)
class ParquetTarget:
    """Offer table, its quarantine beside it, and CSV folders for what neither takes.

    ``arranged`` tables are written in an order that lets fences on price and clock skip.
    """

    path: str
    csv: str = ""
    arranged: bool = False

    def append(self, batch: DataFrame, clean: bool, one_date: bool) -> None:
        if self.arranged and clean:
            return append_arranged(batch, self.path)
        append_offers(batch, self.path if clean else f"{self.path}{QUARANTINE_SUFFIX}", one_date)

    def csv_folder(self, clean: bool) -> str:
        """Raw and clean rows have different types, so each has a folder."""
        return f"{self.csv or self.path}{'' if clean else QUARANTINE_SUFFIX}.csv"

    def read(self, spark: SparkSession) -> DataFrame:
        return read_offers(spark, self.path)


@dataclass(frozen=True)
class JdbcTarget:
    """The same as database tables; ``csv`` names the fallback folder."""

    url: str
    table: str
    csv: str
    options: tuple[tuple[str, str], ...] = ()

    def append(self, batch: DataFrame, clean: bool, one_date: bool) -> None:
        append_jdbc(batch, self.url, self.table if clean else f"{self.table}{QUARANTINE_SUFFIX}", **dict(self.options))

    def csv_folder(self, clean: bool) -> str:
        return f"{self.csv}{'' if clean else QUARANTINE_SUFFIX}.csv"

    def read(self, spark: SparkSession) -> DataFrame:
        return read_offers_jdbc(spark, self.url, self.table, **dict(self.options))


Target = ParquetTarget | JdbcTarget


def target_of(where: "str | Target") -> Target:
    """A path stands for a Parquet table."""
    return ParquetTarget(where) if isinstance(where, str) else where
