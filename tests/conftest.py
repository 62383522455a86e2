import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

import seed  # noqa: E402

from tidewatch.plans.drift_plan import drift_tables  # noqa: E402
from tidewatch.session import build_session  # noqa: E402
from tidewatch.sources.schemas import RAW_METRICS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(seed.rows(), RAW_METRICS).cache()


@pytest.fixture(scope="session")
def tables(raw):
    built = drift_tables(raw)
    for frame in (built.rolling, built.drift, built.alerts):
        frame.cache()
    return built
