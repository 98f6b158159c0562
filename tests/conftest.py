import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from offerlens.schema import OFFER, RAW_OFFER  # noqa: E402
from offerlens.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def offers(spark):
    """Typed offers from tuples; a missing date is filled in."""
    from datetime import date

    def make(rows):
        return spark.createDataFrame([(*r, date(2023, 1, 1)) if len(r) == 5 else r for r in rows], OFFER)

    return make


@pytest.fixture
def raw_offers(spark):
    from datetime import date

    def make(rows):
        return spark.createDataFrame([(*r, date(2023, 1, 1)) if len(r) == 5 else r for r in rows], RAW_OFFER)

    return make
