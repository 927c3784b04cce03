import tempfile

import pytest

from shelfwise.plans.workspace import AS_OF, workspace
from shelfwise.session import builder
from tests.compare import duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def work(spark):
    return workspace(spark, FOLDER, AS_OF)


@pytest.fixture(scope="session")
def con():
    return duck(FOLDER)
