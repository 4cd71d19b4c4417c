import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tessera.session import apply_scale_conf, checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_scale_conf(s)
    checkpoint_dir(s)
    yield s
