import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from breathline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def one(spark):
    """Evaluate columns over one row of literals: ``one(a=1)(F.col("a") + 1)``."""
    def with_values(_schema=None, **values):
        frame = spark.createDataFrame([tuple(values.values())], _schema or list(values))
        return lambda *columns: tuple(frame.select(*columns).first())
    return with_values
