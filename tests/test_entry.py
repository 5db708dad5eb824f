"""The driver's entry module, with and without the training-data subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_package():
    """What is left when corpus_pipeline.py and the subpackage are not there."""
    code = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.split(".")[:2] == ["loadsmith", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not any(k.startswith("op") and k[2].isdigit() or k == "pipeline" for k in e.queries())
assert len(e.queries()) >= 40 and set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
