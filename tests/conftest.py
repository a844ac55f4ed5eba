import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabkit.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tabkit-tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """150 ferry trips and one repeated row; four fares are missing, long waits make a trip late."""
    rng = np.random.default_rng(71)
    rows = []
    for k in range(150):
        pier = ("North", "South", "East")[int(rng.integers(0, 9)) // 3]
        wait = int(rng.integers(1, 45))
        fare = None if k % 40 == 7 else round(3.5 + 0.25 * float(rng.integers(0, 60)), 2)
        day = np.datetime64("2023-03-05") + 2 * k
        late = "Yes" if wait + 10 * (pier == "East") + rng.normal(0, 9) > 30 else "No"
        rows.append((f"T{k:04d}", pier, wait, fare, str(day), late))
    rows.append(rows[0])
    return spark.createDataFrame(rows, "trip string, pier string, wait int, fare double, day string, late string")


def rows_of(df, *columns):
    return sorted([tuple(r) for r in (df.select(*columns) if columns else df).collect()], key=str)
