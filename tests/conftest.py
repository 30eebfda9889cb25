import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from critiq.session import build_session

    s = build_session("local[4]", 8, app="critiq-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def explain_text(df, mode="formatted"):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
