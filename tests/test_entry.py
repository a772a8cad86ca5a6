"""The entry point without the folders for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def loads(folder, *without):
    for name in ("catalogue", "moodtide"):
        shutil.copytree(ROOT / name, folder / name, ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1') for n in e.queries()))"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_loads_without_the_training_data_package(tmp_path):
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir()
    second.mkdir()
    expected = loads(first, "llm", "corpus_pipeline.py")
    assert int(expected[0]) > 60 and expected[1] == "False"
    assert loads(second, "llm") == expected
