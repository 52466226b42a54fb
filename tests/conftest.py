import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from ledgerline.session import local_session  # noqa: E402
from ledgerline.sources.readers import Tables  # noqa: E402

SF = os.environ.get("LEDGERLINE_SF", "0.01")


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def folder():
    return f"/root/testdata/sf{SF}"


@pytest.fixture(scope="session")
def tables(spark, folder):
    return Tables(spark, folder)
