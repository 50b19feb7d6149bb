import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from firmalign.functions import vocabulary as v  # noqa: E402
from firmalign.session import local_session  # noqa: E402
from testing_paths import SF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from firmalign.catalog.queries import Data
    return Data(spark, SF)


@pytest.fixture
def firms(spark):
    """Build a firm table from (firm_id, payer_id, name) triples."""
    def build(rows):
        payload = ", ".join(f"{c} string" for c in v.PAYLOAD_COLS)
        empty = (None,) * len(v.PAYLOAD_COLS)
        return spark.createDataFrame([tuple(r) + empty for r in rows],
                                     f"firm_id bigint, payer_id string, name string, {payload}")
    return build


@pytest.fixture
def masters(spark):
    """Build a master table from (firm_id, fac, pro, elig, name[, payer_id]) rows."""
    def build(rows):
        rest = v.ENROLLMENT_COLS + v.FLAG_COLS
        cols = ("firm_id bigint, payer_id string, name string, "
                + ", ".join(f"{c} string" for c in v.ID_COLS + rest))
        out = [(r[0], r[5] if len(r) > 5 else None, r[4], r[1], r[2], r[3])
               + tuple(f"{c}-{r[0]}" for c in rest) for r in rows]
        return spark.createDataFrame(out, cols)
    return build
