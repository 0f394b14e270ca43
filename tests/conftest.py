import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallygrove.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    from checks.fixtures import clean_sample

    return clean_sample(spark, SMALL)


@pytest.fixture(scope="session")
def dirty(spark):
    from checks.fixtures import dirty_sample

    return dirty_sample(spark, SMALL)


def plan_of(df) -> str:
    """The physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
