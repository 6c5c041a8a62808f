import subprocess
import sys

import pytest

from tests.oracle import connect, same
from voicecorpus.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, con, name):
    same(spark, con, Q.QUERIES[name], Q.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES)))
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


def test_entry_works_without_the_llm_folders():
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('voicecorpus.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 30 and set(e.oracle_sql()) <= set(e.queries()) and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
