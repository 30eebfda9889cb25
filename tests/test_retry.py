"""Results stay exact when tasks fail and are retried (the local stand-in for a lost executor)."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT, SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def test_ranks_and_tfidf_survive_task_retries():
    script = os.path.join(ROOT, "tests", "scripts", "retry_check.py")
    out = subprocess.run([sys.executable, script, SF_SMALL], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and out.stdout.strip().endswith("OK"), out.stderr[-3000:]
