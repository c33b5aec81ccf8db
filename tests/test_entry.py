"""The driver's functions where training-data operators can't be imported."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[{name!r}] = None  # an import of it fails
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 40 and not any(n.startswith("op1_") for n in names) and "pipeline" not in names, names
assert len(entry.oracle_sql()) > 40
"""


@pytest.mark.parametrize("name", ["xxhash", "public_tokenizers", "zstandard", "plexwell.llm"])
def test_other_queries_stay(name):
    subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, check=True)
