import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hebdo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="hebdo-tests")
    yield s
    s.stop()


def d(text):
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, order=None):
    """Collect as a list of dicts, sorted for stable comparison."""
    out = [r.asDict() for r in df.collect()]
    keys = order or (list(out[0]) if out else [])
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in (r[k] for k in keys)))
