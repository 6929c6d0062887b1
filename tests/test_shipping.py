import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from tickloom.plans.registry import all_queries
from tickloom.session import local_session
spark = local_session("2", partitions=2, app="tickloom-elsewhere")
print("alerts", all_queries()["alerts"](spark, sys.argv[2]).count())
"""


def test_python_operators_run_from_another_folder(tmp_path, sf_dir):
    """The workers get the package from the session, not from the folder they start in."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", RUN, ROOT, sf_dir], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("alerts")[1]) > 0
