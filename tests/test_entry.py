import glob
import io
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import normal  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 500 and "predicted_class" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert len(got)
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)


@pytest.mark.parametrize("name", ["checkpoint_roundtrip", "tune_smoke", "tune_minibatch", "score_blocks", "gradient_step"])
def test_query_without_the_package_settings(spark, sf_dir, duck, name):
    """On a session that leaves Arrow conversion off, as any user's may."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    got = entry.queries()[name](plain, sf_dir).toPandas()
    assert normal(got) == normal(duck.execute(entry.oracle_sql()[name]).fetchdf())


_ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
conf = {"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": sys.argv[2]}
spark = SparkSession.builder.config(map=conf).getOrCreate()
before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
for name in sys.argv[4:]:
    entry.queries()[name](spark, sys.argv[3]).toPandas().to_json(f"{sys.argv[2]}/{name}.json", orient="records", double_precision=15)
assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
"""


def test_state_processors_in_a_plain_session_of_another_folder(duck, sf_dir, tmp_path):
    """The driver's own workers do not find the package in the working folder, and the session's store is the default."""
    names, root = ("job_timeouts", "stream_asha_async"), os.path.dirname(os.path.abspath(entry.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", _ELSEWHERE, root, str(tmp_path), sf_dir, *names], cwd=tmp_path, env=env, timeout=300, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-3000:]
    for name in names:
        want = duck.execute(entry.oracle_sql()[name]).fetchdf()
        got = pd.read_json(io.StringIO((tmp_path / f"{name}.json").read_text()), dtype=False, convert_dates=False)
        assert normal(got[list(want.columns)].astype(want.dtypes)) == normal(want)
