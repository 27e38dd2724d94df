"""Driver contract."""

from __future__ import annotations

import os
import pathlib
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from claimweave.plans import load_catalog


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["id_persona_afiliado", "diag_h_2_cronicos", "fecha_antiguedad_dx"]
    assert df.count() > 0


def test_query_keys_have_no_reserved_prefix():
    for name in load_catalog():
        assert not name.startswith("op") and "pipeline" not in name
    assert set(load_catalog()) <= set(entry.queries())


def test_library_works_without_the_optional_subpackage(tmp_path):
    """A copy of the repository without the training-data operators still imports."""
    root = pathlib.Path(entry.__file__).parent
    for name in ("claimweave", "__spark_entry__.py"):
        source = root / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path)
    (tmp_path / "claimweave" / "llm").mkdir()  # an empty folder may stay behind
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(tmp_path)})
    n = str(len(load_catalog()))
    assert done.stdout.split() == [n, n], done.stderr
