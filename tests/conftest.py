import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    own = tempfile.mkdtemp(prefix="panelkit-tests-")
    s = get_spark("local[4]", app="panelkit-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": f"{own}/checkpoints", "spark.sql.warehouse.dir": f"{own}/warehouse"})
    yield s


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
