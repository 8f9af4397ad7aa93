import signal
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_SMALL = "/root/testdata/sf0.001"


LIMIT_S = 240


@pytest.fixture(autouse=True)
def time_limit():
    """A test that hangs fails alone, instead of holding up all others."""
    def stop(*_):
        raise TimeoutError(f"more than {LIMIT_S} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(LIMIT_S)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from callejero.session import tune

    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Apply a Column function to a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, x string").repartition(2)
        return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
