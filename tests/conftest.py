import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from panelforge.session import apply_conf

    ckpt = tempfile.mkdtemp(prefix="pf-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("panelforge-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Column values as lists, in DataFrame order."""
    recs = df.collect()
    if len(cols) == 1:
        return [r[cols[0]] for r in recs]
    return [tuple(r[c] for c in cols) for r in recs]
