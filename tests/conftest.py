import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))
# Test helpers that are sent to Python tasks must be importable there.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newstide.session import build_session

    session = build_session(
        "newstide-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
