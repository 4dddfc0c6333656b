"""The entry point without the packages or folders of its optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent
BLOCKED = """
import sys
class Blocker:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocker())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), "headline" in entry.queries(),
      any(q.startswith("op") or q == "pipeline" for q in entry.queries()))
"""


def listed(name):
    said = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, text=True,
                          capture_output=True, check=True)
    return said.stdout.split()


def test_log_queries_remain_whatever_is_missing():
    for name in ("ahocorasick", "public_tokenizers", "loglathe.llm", "corpus_pipeline"):
        queries, oracles, headline, corpus = listed(name)
        assert int(queries) > 50 and int(queries) == int(oracles)
        assert (headline, corpus) == ("True", "False")
