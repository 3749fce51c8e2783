import os
import sys
from decimal import Decimal
from types import SimpleNamespace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import connect, local_session  # noqa: E402
from checks.layers import SampleLayers  # noqa: E402
from ledgerstrata.plans.jobs import LayerPaths  # noqa: E402
from ledgerstrata.sources import schemas  # noqa: E402
from ledgerstrata.sources.layers import read_layer, write_layer  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))  # keeps the warehouse folder out of the repository
    session = local_session(8, "ledgerstrata-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="session")
def sample(spark, sf_dir):
    return SampleLayers(spark, sf_dir)


@pytest.fixture(scope="session")
def stored(spark, sample, tmp_path_factory):
    """The faulty sample layers as stored layers."""
    paths = LayerPaths(str(tmp_path_factory.mktemp("layers")))
    write_layer(sample.bronze, paths.bronze)
    write_layer(sample.silver, paths.silver)
    write_layer(sample.gold, paths.gold)
    return SimpleNamespace(
        paths=paths,
        bronze=read_layer(spark, paths.bronze, schemas.BRONZE),
        silver=read_layer(spark, paths.silver, schemas.SILVER),
        gold=read_layer(spark, paths.gold, schemas.GOLD),
    )


class Make:
    """Small layers from tuples of text; None stays NULL."""

    def __init__(self, session):
        self.spark = session

    def _rows(self, rows, schema):
        text = ", ".join(f"{f.name} string" for f in schema)
        df = self.spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in row) for row in rows], text
        )
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])

    def bronze(self, *rows):
        """(id, booked_at, amount, type, date)"""
        return self._rows(rows, schemas.BRONZE)

    def silver(self, *rows):
        """(id, booked_at, amount, type, valid, date)"""
        return self._rows(rows, schemas.SILVER)

    def gold(self, *rows):
        """(type, total, count, date)"""
        return self._rows(rows, schemas.GOLD)


@pytest.fixture(scope="session")
def make(spark):
    return Make(spark)


def rows(df, *columns):
    """Rows as tuples, with decimals as floats and dates as text."""

    def plain(v):
        if isinstance(v, Decimal):
            return float(v)
        return v.isoformat() if hasattr(v, "isoformat") else v

    picked = df.select(*columns) if columns else df
    return [tuple(plain(v) for v in r) for r in picked.collect()]
