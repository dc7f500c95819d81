import os

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")  # before numpy is loaded

import pytest  # noqa: E402

from tests.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()
