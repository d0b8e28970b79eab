import json
import os
import subprocess
import sys

from plumbline.plans.catalog import QUERIES


def test_bench_prints_one_json_line(sf_dir):
    script = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "bench.py")
    environment = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4", "BENCH_ROUNDS": "1"}
    done = subprocess.run([sys.executable, script], env=environment, capture_output=True, timeout=1200)
    assert done.returncode == 0, done.stderr.decode()[-2000:]
    (line,) = done.stdout.decode().splitlines()
    result = json.loads(line)
    assert set(result["queries"]) >= set(QUERIES)
    assert set(result["setup"]) == {"reviews", "landed_read", "stage_report_parse", "stage_metrics"}
    assert set(result["fold_variants"]) == {"scan", "translate", "replace_first"}
    assert result["ingest_run_merged"] > 0
    assert (result["unit"], result["sf"]) == ("sec", "0.001")
    assert result["value"] > 0
