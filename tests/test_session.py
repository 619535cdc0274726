import os
import pathlib
import subprocess
import sys
from types import SimpleNamespace

import pytest

from tallycast import session


def fake(conf, folder, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: conf or default), sparkContext=context)


def test_the_configured_folder_is_used():
    assert session.shared_folder(fake("hdfs://shared/x/", None, "yarn")) == "hdfs://shared/x"
    assert session.shared_folder(fake(None, "hdfs://set/y", "yarn")) == "hdfs://set/y"


def test_a_cluster_never_falls_back_to_a_local_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(fake(None, None, "yarn"))


def test_materialized_tables_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01 08:00:00' AS ts", "named_struct('a', id) AS s")
    back = session.materialize(df)
    assert back.schema.simpleString() == df.schema.simpleString() and set(back.collect()) == set(df.collect())


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Queries with Python workers from another folder, with the package on the driver's path only."""
    root = pathlib.Path(__file__).resolve().parent.parent
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from tallycast.session import local_session
from tallycast.plans import catalog
spark = local_session(2, "away", **{{"spark.executorEnv.PYTHONPATH": ""}})
rows = catalog.QUERIES["ar_fit_exact_p1"](spark, "/root/testdata/sf0.001").collect()
assert len(rows) == 5
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.stdout.strip().endswith("done"), ran.stderr[-2000:]
