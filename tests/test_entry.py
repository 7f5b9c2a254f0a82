"""The entry points in a copy of the repository without the optional folders, and from another folder."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

IMPORTS = """
import sys
sys.path.insert(0, {copy!r})
import __spark_entry__ as entry
names = set(entry.queries())
assert "so_po_combination" in names and set(entry.oracle_sql()) <= names
assert not [n for n in names if n.startswith("op") and n[2].isdigit()], names
assert "pipeline" not in names
"""

WORKERS = """
import sys
sys.path.insert(0, {root!r})
from millrace import session
spark = session.build("elsewhere", "local[1]", **{{"spark.ui.enabled": "false"}})

def names(batches):
    import pyarrow as pa
    from millrace.sources import formats
    for batch in batches:
        yield pa.RecordBatch.from_pydict({{"name": [formats.__name__] * batch.num_rows}})

assert {{r.name for r in spark.range(3).mapInArrow(names, "name string").collect()}} == {{"millrace.sources.formats"}}
spark.stop()
"""


def copied(folder, *left_out):
    shutil.copytree(os.path.join(ROOT, "millrace"), folder / "millrace", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), folder)
    return str(folder)


def run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]


def test_entry_imports_without_the_optional_folders(tmp_path):
    run(IMPORTS.format(copy=copied(tmp_path / "bare", "llm")), str(tmp_path))


def test_entry_imports_when_only_the_pipeline_file_is_left(tmp_path):
    copy = copied(tmp_path / "left", "llm")
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    if os.path.exists(pipeline):
        shutil.copy(pipeline, copy)
    run(IMPORTS.format(copy=copy), str(tmp_path))


def test_workers_find_the_package_from_any_folder(tmp_path):
    run(WORKERS.format(root=ROOT), str(tmp_path))
