import pytest

import __spark_entry__ as contract
from shopledger.queries.oracle import ORACLE
from shopledger.queries.registry import QUERIES
from tools.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, oracle, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_only_a_missing_corpus_package_is_passed_over(tmp_path):
    """Without the corpus folders the entry has the other queries; without a package they
    need it fails."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(contract.__file__).parent
    for name in ("shopledger", "corpus_pipeline.py", "__spark_entry__.py"):
        copy = shutil.copytree if (root / name).is_dir() else shutil.copy
        ignored = {"ignore": shutil.ignore_patterns("llm", "__pycache__")} if name == "shopledger" else {}
        copy(root / name, tmp_path / name, **ignored)
    count = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"

    def run(code):
        env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join([str(tmp_path), *sys.path[1:]])}
        return subprocess.run(
            [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True
        )

    assert run(count).stdout.split() == [str(len(QUERIES))] * 2
    if (root / "shopledger/llm").exists():
        shutil.copytree(root / "shopledger/llm", tmp_path / "shopledger/llm")
        broken = run("import sys; sys.modules['zstandard'] = None; " + count)
        assert broken.returncode != 0 and "zstandard" in broken.stderr
