import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from check import session

    spark = session(threads=8, partitions=4)
    yield spark
    from canopycast.sources.staging import release

    release(spark)
    spark.stop()
