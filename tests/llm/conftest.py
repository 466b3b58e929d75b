import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    """Python workers import the package from this folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
