import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from meterwise.llm.common import tuned  # noqa: E402


@pytest.fixture(autouse=True)
def settings(spark):
    tuned(spark)
