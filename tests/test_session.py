"""Session settings of the submitter are kept, and scratch tables go."""

import os
import subprocess
import sys

from corate import session
from corate.session import ensure_checkpoint_dir, materialize, release_scratch, scratch_scope
from tests.conftest import ROOT

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from corate.session import build_session, materialize
spark = build_session()
sc = spark.sparkContext
print(sc.master, spark.conf.get("spark.sql.shuffle.partitions"), sc.getCheckpointDir().startswith({path!r}))
materialize(spark.range(5), "left")
print(len([f for _, d, _ in os.walk({path!r}) for f in d if f.startswith("corate-left")]))
"""


def test_submitted_settings_are_kept_and_scratch_goes_with_the_application(tmp_path):
    shared = str(tmp_path / "shared")
    args = f"--master local[2] --conf spark.sql.shuffle.partitions=400 --conf spark.checkpoint.dir=file://{shared} pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args}
    code = SCRIPT.format(root=ROOT, path=f"file:{shared}").replace(f"os.walk('file:{shared}')", f"os.walk({shared!r})")
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=240)
    lines = done.stdout.split("\n")
    assert lines[:2] == ["local[2] 400 True", "1"], done.stderr[-2000:]
    left = [f for _, d, _ in os.walk(shared) for f in d if f.startswith("corate-")]
    assert left == []


def _tables(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("corate-scope")}


def test_a_scope_deletes_its_tables(spark):
    outer = materialize(spark.range(3), "scope-outer")
    before = _tables(spark)
    with scratch_scope(spark):
        materialize(spark.range(4), "scope-a")
        with scratch_scope(spark):
            materialize(spark.range(4), "scope-b")
            assert len(_tables(spark)) == len(before) + 2
        assert len(_tables(spark)) == len(before) + 1
    assert _tables(spark) == before and outer.count() == 3


def test_everything_can_be_released(spark):
    with scratch_scope(spark):
        materialize(spark.range(4), "scope-c")
        release_scratch(spark, keep=len(session._written) - 1)
        assert not any("scope-c" in f for f in _tables(spark))
