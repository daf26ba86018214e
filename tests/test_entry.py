"""The driver entry with and without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

HIDDEN = """
import importlib.util, sys
real = importlib.util.find_spec
importlib.util.find_spec = lambda name, *more: None if name.split(".")[:2] == ["kestrel", "llm"] else real(name, *more)
class Refuse:
    def find_spec(self, name, path=None, target=None):
        if name == "kestrel.llm" or name.startswith("kestrel.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Refuse())
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 100, len(names)
assert not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


def test_entry_works_where_the_training_data_folder_is_missing():
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
