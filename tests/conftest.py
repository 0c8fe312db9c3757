import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scoreflow.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", shuffle_partitions=8, app_name="scoreflow-tests")
    yield s


@pytest.fixture(scope="session")
def passengers(spark):
    """The 8-row golden fixture (fit and transform on the same rows)."""
    rows = [
        (1, 1, "Doe, Mr. A", "male", 30.0, 0, 0, 10.0, "S"),
        (2, 1, "Doe, Mrs. B (Dr. X)", "female", 40.0, 1, 0, 20.0, "C"),
        (3, 2, "Doe, Miss. C", "female", 12.0, 0, 2, 30.0, "S"),
        (4, 3, "Doe, Mr. D", "male", None, 0, 0, 40.0, None),
        (5, 3, "Doe, Master. E", "male", 4.0, 3, 1, 50.0, "Q"),
        (6, 2, "Doe, Rev. F", "male", 61.0, 0, 0, None, "S"),
        (7, 1, "Doe, Zzz. G", "female", 35.0, 0, 0, 80.0, "C"),
        (8, 3, "NoTitle", "male", None, 1, 1, 8.0, "Q"),
    ]
    schema = ("subject_id long, tier int, full_name string, sex string, age double, "
              "sibsp int, parch int, fare double, port string")
    return spark.createDataFrame(rows, schema)
