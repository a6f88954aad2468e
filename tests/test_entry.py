"""The entry module where the training-data folders are not there."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_are_listed_without_the_training_data_folder(tmp_path):
    """With ``corpus_pipeline.py`` still there, and with it gone, too."""
    away = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "tidegauge", tmp_path / "tidegauge", ignore=away)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from tidegauge.llm.common import table\n")
    told = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q, 'score_ticks' in q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    with_it = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, env=env, capture_output=True, text=True)
    os.remove(tmp_path / "corpus_pipeline.py")
    without = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert with_it.returncode == 0, with_it.stderr
    assert with_it.stdout == without.stdout and with_it.stdout.split()[1:] == ["False", "True"]
