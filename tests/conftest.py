import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import ensure_checkpoint_dir, local_session

    session = local_session(8, shuffle_partitions=4)
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def lake_root(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "test-lake")
