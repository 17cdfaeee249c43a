import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from taxaloom.session import clear_staging, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staging(session)


# Toy cohort: four made-up species, three samples per group; T6 is empty and Reed and Tansy have ties.
TOY = {
    "Quill": [4, 9, 30, 2, 1, 0],
    "Marl": [16, 7, 8, 25, 1, 0],
    "Tansy": [5, 5, 0, 12, 40, 0],
    "Reed": [1, 0, 2, 2, 6, 0],
}


@pytest.fixture(scope="session")
def toy(spark):
    rows = [(f"T{i + 1}", f, float(v)) for f, values in TOY.items() for i, v in enumerate(values) if v]
    return spark.createDataFrame(rows, "sample_name string, feature string, value double")


@pytest.fixture(scope="session")
def toy_meta(spark):
    rows = [(f"T{i + 1}", "North" if i < 3 else "South") for i in range(6)]
    return spark.createDataFrame(rows, "sample_name string, group string")
