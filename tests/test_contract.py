"""The driver's contract: bench.py prints one JSON line with the required
keys; the entry module exposes entry/queries/oracle_sql."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "count_greetings"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == "0.001" and "count_greetings" in d["queries"]
    assert d["errors"] == {}


def test_entry_module_shape():
    assert callable(E.entry)
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 43 and set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
