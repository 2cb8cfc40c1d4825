"""The contract of the entry module and of the bench."""

import importlib.util
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from millrace.session import build_session, shared_dir

HOME = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("entry", HOME / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry(spark, entry_module):
    result = entry_module.entry(spark)
    assert dict(result.dtypes) == {"word": "string", "count": "bigint"}
    assert result.count() > 0


def test_sql_belongs_to_queries(entry_module):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(callable(q) for q in queries.values())
    queries.clear()
    assert entry_module.queries()


def test_bench_prints_one_line_of_json():
    env = os.environ | {
        "BENCH_SF_DIR": "/root/testdata/sf0.001",
        "BENCH_CPUS": "2",
        "BENCH_ONLY": "rewards,peek_rows",
    }
    run = subprocess.run(
        [sys.executable, HOME / "bench.py"], env=env, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr[-2000:]
    (line,) = run.stdout.strip().splitlines()
    report = json.loads(line)
    assert set(report["queries"]) == {"rewards", "peek_rows"}
    assert report["unit"] == "sec" and report["sf"] == "0.001"
    assert report["value"] == pytest.approx(sum(report["queries"].values()), abs=0.01)


def test_cluster_must_name_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert Path(shared_dir(Session())).is_dir()
    assert shared_dir(Session()) == shared_dir(Session())


def test_session_settings(spark):
    session = build_session("again", conf={"spark.sql.adaptive.coalescePartitions.enabled": "true"})
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
