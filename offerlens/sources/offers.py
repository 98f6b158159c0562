"""Reading stored offers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from offerlens.schema import OFFER, OFFER_COLUMNS

# CSV texts keep their padding, quotes and line breaks.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_offers(spark: SparkSession, path: str | list[str], source: str = "parquet", schema: StructType = OFFER) -> DataFrame:
    """The six offer columns of a stored table; only they are read.

    ``source`` is any file source of Spark. A CSV fallback file is read with the
    missing text it was written with. Quarantined offers have the raw schema.
    """
    reader = spark.read.schema(schema)
    if source == "csv":
        reader = reader.options(header=True, nullValue="NaN", multiLine=True, **CSV_TEXT)
    return reader.format(source).load(path).select(*OFFER_COLUMNS)


def read_offers_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The six offer columns of a database table.

    Pass ``partitionColumn="date"`` with ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that many tasks share the read of a large table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**options).load().select(*OFFER_COLUMNS)
