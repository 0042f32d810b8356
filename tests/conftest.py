import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="matchlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from matchlake.session import work_dir

    return work_dir(spark, "test")


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
