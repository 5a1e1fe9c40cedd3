import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from claimloom.session import session

    made = session("local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g")
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
