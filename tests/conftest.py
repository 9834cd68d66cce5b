import os
import uuid

import pytest

from terrane.session import build_session
from terrane.sources import Lake


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("terrane-tests", {
        "spark.master": f"local[{os.cpu_count()}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "4",
        # The fixtures are tiny: compiling generated code would take most of the time.
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": str(root / "scratch"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """A lake of its own for each test: other tests' tables leave the catalog first."""
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    return Lake(spark, str(tmp_path / uuid.uuid4().hex))


@pytest.fixture
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make
