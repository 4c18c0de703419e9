import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from debutrank.session import local_session, release, use_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "debutrank-tests", "4g")
    session.sparkContext.setLogLevel("ERROR")
    use_folder(session, str(tmp_path_factory.mktemp("work")))
    yield session
    release(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
