"""The entry without the corpus operators, or without a library that only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys
blocked = sys.argv[1]
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == blocked or name.startswith(blocked + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = set(entry.queries())
assert not any(name.startswith("op") or name == "pipeline" for name in names), names
assert names == set(entry.oracle_sql())
print(len(names))
"""


@pytest.mark.parametrize(
    "module", ["sediment.llm", "corpus_pipeline", "tiktoken", "public_tokenizers", "xxhash", "tokenizers"]
)
def test_core_queries_stay_without(module):
    done = subprocess.run([sys.executable, "-c", BLOCKED, module], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) >= 38
