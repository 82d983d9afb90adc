import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import connect  # noqa: E402
from tidewatch.session import get_spark, remove_work  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", master="local[8]", shuffle_partitions=2)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_work(session)
    session.stop()


@pytest.fixture(scope="session")
def shared_layers():
    """Tables that many queries derive are written once per run instead of once per query."""
    from tidewatch.plans import bindings
    from tidewatch.sources.layers import settle

    with pytest.MonkeyPatch.context() as patch:
        for name in ("offset_hourly", "training_set", "training_people"):
            original = getattr(bindings, name)
            written = {}

            def once(spark, sf, original=original, written=written, name=name):
                if sf not in written:
                    written[sf] = settle(original(spark, sf), name)
                return written[sf]

            patch.setattr(bindings, name, once)
        yield


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)
