from __future__ import annotations

import pytest

from fathomline.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[8]", "tests", spark__sql__shuffle__partitions="8", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
