import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vaportrail.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Bronze records from dicts; absent fields are NULL."""
    from vaportrail.schemas import RECORD

    def make(*records: dict):
        return spark.createDataFrame(
            [tuple(record.get(name) for name in RECORD.names) for record in records], RECORD
        )

    return make


@pytest.fixture(scope="session")
def airspaces(spark):
    from vaportrail.plans.gold import airspace_index, spatial_airspaces
    from vaportrail.sources.seeds import known_airspaces

    return airspace_index(spatial_airspaces(known_airspaces(spark)))
