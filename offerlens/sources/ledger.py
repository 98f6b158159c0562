"""An offer table whose loads are whole or absent.

A load writes its rows, and the counts that the analysis needs of them, to folders of its own
that nobody reads yet. Then one entry in the ledger names its runs and where each went: into the
table, the quarantine, or the CSV fallback. Entries are numbered, and an entry appears by renaming
a folder to the next number, which succeeds for one writer only; a writer that comes second looks
again at what the first one published. Readers take the folders that entries name, so a
load that breaks off shows nothing, and one that is repeated finds its runs in the ledger.

The file system must rename folders atomically, as HDFS and local disks do.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.operators.summary import CELLS, PAIRS, cell_counts, pair_counts
from offerlens.schema import DATE, OFFER, RAW_OFFER
from offerlens.sources.offers import read_offers
from offerlens.sources.sinks import append_csv, append_offers
from offerlens.staging import folder_names

#: What an entry says of each run of its load. ``load`` is the name of the load's folders.
ENTRY = "run_date date, n_rows long, is_clean boolean, target string, load string"


@dataclass(frozen=True)
class LedgerTarget:
    """Folders of loads below ``path``, or below ``csv`` for the fallback, and the ledger beside them."""

    path: str
    csv: str = ""
    ledger: str = ""

    @property
    def _entries(self) -> str:
        return self.ledger or f"{self.path}/ledger"

    def folder(self, kind: str, load: str, is_clean: bool = True) -> str:
        """Where a load's rows are; raw and clean CSV rows have different types, so each has a folder."""
        if kind == "csv":
            return f"{self.csv or self.path}/csv-{'clean' if is_clean else 'raw'}/{load}"
        return f"{self.path}/{kind}/{load}"

    def write(self, batch: DataFrame, is_clean: bool, load: str) -> str:
        """Write rows that no entry names yet; the kind of folder that took them.

        Only what keeps the table from taking the rows sends them to the fallback. A load that cannot be
        counted breaks off instead: its rows would be missing from every analysis of the counts.
        """
        kind = "table" if is_clean else "quarantine"
        try:
            append_offers(batch, self.folder(kind, load))
        except Exception:  # whatever keeps the table from taking the rows; nothing of it is visible
            append_csv(batch, self.folder("csv", load, is_clean))
            return "csv"
        if is_clean:
            # Counted from what was written, where texts are numbers already.
            stored = read_offers(batch.sparkSession, self.folder(kind, load))
            pair_counts(stored).write.parquet(self.folder("pairs", load))
            cell_counts(stored).write.parquet(self.folder("cells", load))
        return kind

    def version(self, spark: SparkSession) -> int:
        """The number of the last entry; 0 for an empty ledger."""
        return max((int(name) for name in folder_names(spark, self._entries) if name.isdigit()), default=0)

    def published(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The runs of all entries up to ``version``, as ``ENTRY``."""
        last = self.version(spark) if version is None else version
        folders = [f"{self._entries}/{number:012d}" for number in range(1, last + 1)]
        return spark.read.schema(ENTRY).parquet(*folders) if folders else spark.createDataFrame([], ENTRY)

    def publish(self, runs: DataFrame, version: int) -> bool:
        """Make a load visible as entry ``version``; False if there is one of that number already."""
        spark = runs.sparkSession
        new = f"{self._entries}/new-{uuid4().hex}"
        runs.select(*[c.split()[0] for c in ENTRY.split(", ")]).coalesce(1).write.parquet(new)
        files, place = _file_system(spark, new), _path(spark, f"{self._entries}/{version:012d}")
        # A local rename would move one folder into the other.
        return not files.exists(place) and files.rename(_path(spark, new), place)

    def loads(self, spark: SparkSession, kind: str, is_clean: bool = True) -> list[str]:
        """The folders of a kind that entries name: one for each load."""
        named = self.published(spark).where((F.col("target") == kind) & (F.col("is_clean") == is_clean))
        return [self.folder(kind, row["load"], is_clean) for row in named.select("load").distinct().orderBy("load").collect()]

    def read(self, spark: SparkSession, kind: str = "table", is_clean: bool = True) -> DataFrame:
        """The published rows of ``table``, ``quarantine`` or ``csv``."""
        schema = OFFER if is_clean and kind != "quarantine" else RAW_OFFER
        folders = self.loads(spark, kind, is_clean and kind != "quarantine")
        if not folders:
            return spark.createDataFrame([], schema)
        if kind == "csv":
            return read_offers(spark, folders, "csv", schema)
        # Folders of dates below folders of loads: each load is a table by itself.
        read = [read_offers(spark, folder, schema=schema) for folder in folders]
        return _union(read)

    def counts(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """The counts of all published clean loads: (brand, model) and (brand, model, price, clock)."""
        loads = [row["load"] for row in self.published(spark).where("target = 'table'").select("load").distinct().collect()]

        def read(kind: str, schema: str) -> DataFrame:
            folders = [self.folder(kind, load) for load in loads]
            return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

        return read("pairs", PAIRS), read("cells", CELLS)

    def sweep(self, spark: SparkSession) -> None:
        """Delete what broken loads left behind; not while another load runs."""
        known = {row["load"] for row in self.published(spark).select("load").distinct().collect()}
        for top in {self.folder(kind, "", clean) for kind in ("table", "quarantine", "pairs", "cells", "csv") for clean in (True, False)}:
            for name in folder_names(spark, top.rstrip("/")):
                if name not in known:
                    _file_system(spark, top).delete(_path(spark, f"{top}{name}"), True)
        for name in folder_names(spark, self._entries):
            if not name.isdigit():
                _file_system(spark, self._entries).delete(_path(spark, f"{self._entries}/{name}"), True)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _union(frames: list[DataFrame]) -> DataFrame:
    """By halves, so that the plan of many loads stays shallow."""
    while len(frames) > 1:
        frames = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def new_load() -> str:
    return uuid4().hex


def fresh(raw: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of runs that ``known`` does not name."""
    seen = known.select(F.col("run_date").alias("__seen")).distinct()
    return raw.join(seen, F.col(DATE).eqNullSafe(F.col("__seen")), "left_anti")
