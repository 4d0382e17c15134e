"""Every module of queries can be imported first, in a process of its own."""

import pkgutil
import subprocess
import sys
from pathlib import Path

import pytest

import tarnlake.plans

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", [m.name for m in pkgutil.iter_modules(tarnlake.plans.__path__)] + [""])
def test_import_alone(name):
    what = f"tarnlake.plans.{name}" if name else "bench"
    ran = subprocess.run([sys.executable, "-c", f"import {what}"], cwd=ROOT, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr[-500:]
