import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"



@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tastebud.session import RECOMMENDED_CONF

    b = (SparkSession.builder.master("local[*]").appName("tastebud-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests own the checkpoint folder (a cluster would name a shared one)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastebud-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tastebud.sources.catalog import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
