import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskline.params import RAW_COLS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from riskline.session import local_session

    s = local_session("*", shuffle_partitions=8, app="riskline-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def raw_rows():
    """4 raw credit rows (25 columns, the reference's unit-test fixture values)."""
    ids = [1, 2, 3, 4]
    limit = [20000, 120000, 50000, 90000]
    sex = [2, 1, 2, 1]
    edu = [2, 2, 1, 3]
    mar = [1, 2, 1, 2]
    age = [24, 47, 33, 52]
    pay = [0, 0, -1, 0]
    bill = [3913, 1000, 500, 0]
    amt = [0, 1000, 200, 0]
    target = [1, 0, 0, 1]
    rows = []
    for i in range(4):
        rows.append([ids[i], limit[i], sex[i], edu[i], mar[i], age[i]] + [pay[i]] * 6 + [bill[i]] * 6 + [amt[i]] * 6
                    + [target[i]])
    return rows


@pytest.fixture()
def sample_raw_df(spark):
    schema = ", ".join(f"`{c}` long" for c in RAW_COLS)
    return spark.createDataFrame(raw_rows(), schema)
