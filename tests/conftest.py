import functools
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pubspark.session import build_session

    scratch = tempfile.mkdtemp(prefix="pubspark-test-")
    s = build_session(master="local[4]", app_name="pubspark-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="pubspark-run-")


@pytest.fixture(scope="session")
def shared_landings(spark):
    """What the registered queries land from the same tables is landed once for all tests."""
    from pubspark.plans import catalog

    patch = pytest.MonkeyPatch()
    for name in ("raw_items", "bronze", "layered_bronze", "layered_build"):
        patch.setattr(catalog, name, functools.cache(getattr(catalog, name)))
    yield
    patch.undo()
