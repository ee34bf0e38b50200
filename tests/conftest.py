import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayframe.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield local_session(4, shuffle_partitions=4)


def rows(df):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
