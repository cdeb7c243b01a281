import os
import shutil
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_operators():
    """The other queries are there when the subpackage and its pipeline are not."""
    copy = os.path.join(tempfile.mkdtemp(prefix="entry-"), "repo")
    shutil.copytree(os.path.join(ROOT, "moodlake"), os.path.join(copy, "moodlake"),
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'silver_tracks' in q and set(s) <= set(q); "
            "assert not any(n.startswith('op') or n == 'pipeline' for n in q)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, env=env, check=True, timeout=120)
