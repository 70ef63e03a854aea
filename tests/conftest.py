import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession, functions as F  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]").appName("docnorm-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from docnorm.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture
def docs(spark):
    """Build (``_seq``, ``doc``) from Python dicts / JSON strings, in the given order."""
    def make(*items):
        rows = [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)]
        df = spark.createDataFrame(rows, "_seq long, j string")
        return df.select("_seq", F.parse_json("j").alias("doc"))
    return make
