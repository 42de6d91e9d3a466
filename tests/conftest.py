import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from filmstrip.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("w")), "spark.checkpoint.dir": str(tmp_path_factory.mktemp("c"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns."""

    def get(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=lambda r: tuple((x is not None, x) for x in r))

    return get
