import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import session

    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")), spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
