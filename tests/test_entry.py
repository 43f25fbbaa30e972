import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()), 'pipeline' in e.queries())"


def imported(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


@pytest.mark.parametrize("left", ["nothing", "only __pycache__", "a part that cannot be imported"])
def test_tabular_queries_stay_without_the_text_part(tmp_path, left):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "tabflow", tmp_path / "tabflow", ignore=skip)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left != "nothing":
        (tmp_path / "tabflow" / "llm" / "__pycache__").mkdir(parents=True)
    if left.startswith("a part"):
        (tmp_path / "tabflow" / "llm" / "queries.py").write_text("import a_library_that_is_not_there\n")
    n, has_text, has_pipeline = imported(tmp_path)
    assert int(n) > 160 and (has_text, has_pipeline) == ("False", "False")
