import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import synthetic_pairs  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from corpusprep.session import get_spark

    s = get_spark("local[4]", 8)
    yield s


@pytest.fixture(scope="session")
def rows64():
    return synthetic_pairs()
