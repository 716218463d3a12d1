import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def listed(root):
    env = dict(os.environ, PYTHONPATH="")
    out = subprocess.run([sys.executable, "-c", LIST], cwd=root, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return [set(line.split()) for line in out.stdout.splitlines()[-2:]]


def copied(to, *left_out):
    shutil.copytree(ROOT, to, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or os.path.relpath(os.path.join(d, n), ROOT) in left_out])
    return to


def test_the_rest_imports_without_the_training_data_operators(tmp_path):
    """Without seqflow/llm and tests/llm, and with or without corpus_pipeline.py, all other queries register."""
    from seqflow.catalog import ORACLE, QUERIES

    for i, more in enumerate([(), ("corpus_pipeline.py",)]):
        queries, oracle = listed(copied(str(tmp_path / str(i)), "seqflow/llm", "tests/llm", *more))
        assert queries == set(QUERIES) and oracle == set(ORACLE)


def test_nothing_else_imports_the_training_data_operators():
    for d, _, names in os.walk(os.path.join(ROOT, "seqflow")):
        if os.path.basename(d) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(d, n), encoding="utf-8") as f:
                    assert "seqflow.llm" not in f.read(), n
