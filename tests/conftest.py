import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 4, spark__driver__memory="4g",
                            spark__sql__streaming__noDataMicroBatches__enabled="false")
    yield session
    session.stop()
