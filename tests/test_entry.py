"""The driver contract: flow queries and their oracles have the same names, and the subpackage of text operators can be missing."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__
from netquarry.plans import registry

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("netquarry.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__
print(len(__spark_entry__.queries()), len(__spark_entry__.oracle_sql()))
"""


def test_every_flow_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(__spark_entry__.queries())


def test_the_rest_works_without_the_text_operators():
    done = subprocess.run([sys.executable, "-c", HIDE], capture_output=True, text=True, cwd=Path(__spark_entry__.__file__).parent, check=True)
    n = len(registry.queries())
    assert done.stdout.split() == [str(n), str(n)]
