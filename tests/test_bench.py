"""bench.py prints one JSON line with every registered query timed."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_smoke():
    some = ["report_fill_rate", "run_report_totals", "csv_dump_geo", "load_append", "audit_summary"]
    assert set(some) <= set(E.queries())
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_RUNS="1", BENCH_JOBS="0", BENCH_CPUS="2",
               BENCH_MEMORY="2g", BENCH_QUERIES=",".join(some))
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and not d["errors"]
    assert set(d["queries"]) == set(some)
    assert d["value"] == round(sum(d["queries"].values()), 4)
