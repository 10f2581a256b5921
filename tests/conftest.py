import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gridpanel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "gridpanel-tests")
    yield session
    session.stop()


def rows(df, *keys):
    """Rows as plain tuples, sorted by the given columns or by everything."""
    found = [tuple(r) for r in df.collect()]
    if keys:
        places = [df.columns.index(k) for k in keys]
        return sorted(found, key=lambda r: tuple(r[p] for p in places))
    return sorted(found, key=lambda r: tuple((v is None, v) for v in r))


def close(a, b, tolerance=1e-9):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))
