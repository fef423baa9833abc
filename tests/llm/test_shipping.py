"""Every key runs where the workers cannot import the package."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys, tempfile
sys.path.insert(0, {root!r})
from corvid.session import build_session
import __spark_entry__ as entry
spark = build_session(master="local[4]", shuffle_partitions=4, checkpoint_dir=tempfile.mkdtemp())

def importable(_):
    import importlib.util
    return importlib.util.find_spec("corvid") is not None

assert spark.sparkContext.parallelize([0], 1).map(importable).collect() == [False]
for name, query in entry.queries().items():
    if name in {names!r}:
        query(spark, {sf!r}).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


@pytest.mark.parametrize("names", [
    ["op1_ppm_scoring", "op2_language_id", "op3_best_fit_packing", "op4_benchmark_decontamination", "op5_licence_scan"],
    ["op6_simhash_near_dedup", "op7_substring_dedup", "op8_warc", "op9_page_differencing", "op10_winnowing"],
    ["op11_bpe_automaton", "op12_embedding_whitening", "op13_conversation_trie", "pipeline"]])
def test_keys_run_from_an_empty_folder_without_the_package(names):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    script = SCRIPT.format(root=ROOT, names=names, sf="/root/testdata/sf0.001")
    run = subprocess.run([sys.executable, "-c", script], cwd=tempfile.mkdtemp(prefix="corvid-elsewhere-"), env=env,
                         capture_output=True, text=True, timeout=1500)
    assert run.returncode == 0, run.stderr[-3000:]
    assert [line.split()[1] for line in run.stdout.splitlines() if line.startswith("ran ")] == names
