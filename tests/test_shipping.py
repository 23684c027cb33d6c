"""Operators whose tasks run Python work from any folder once the package is shipped."""

import subprocess
import sys
import tomllib
import zipfile
from pathlib import Path

from tarmac import session

ROOT = Path(__file__).resolve().parent.parent

_JOB = """
import sys
sys.path.append({root!r})
from tarmac.session import local_session, ship
spark = local_session(2)
spark.sparkContext.setLogLevel("OFF")
if {shipped}:
    ship(spark)
    ship(spark)
from tarmac.operators.moments import correlations
rows = correlations(spark.range(50).selectExpr("id * 1.0D AS x", "id * -2.0D AS y"), ["x", "y"]).collect()
print("r", [round(r["r"], 6) for r in rows if r["x"] != r["y"]])
"""


def _run(tmp_path, shipped):
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", _JOB.format(root=str(ROOT), shipped=shipped)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)


def test_shipped_package_reaches_the_workers(tmp_path):
    done = _run(tmp_path, True)
    assert done.returncode == 0 and "r [-1.0]" in done.stdout, done.stderr[-2000:]


def test_without_it_they_cannot_import(tmp_path):
    done = _run(tmp_path, False)
    assert done.returncode != 0 and "No module named 'tarmac'" in done.stderr


def test_archive_holds_every_module(spark):
    session.ship(spark)
    archive = next(p for p in spark.sparkContext._python_includes if p == "tarmac.zip")
    folder = next(Path(p).parent for p in sys.path if p.endswith(archive))
    names = set(zipfile.ZipFile(folder / archive).namelist())
    assert names == {str(p.relative_to(ROOT)) for p in (ROOT / "tarmac").rglob("*.py")}


def test_project_file_names_the_package():
    project = tomllib.loads((ROOT / "pyproject.toml").read_text())
    assert project["project"]["name"] == "tarmac"
    assert project["tool"]["setuptools"]["packages"]["find"]["include"] == ["tarmac*"]
