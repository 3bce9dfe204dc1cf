import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vaultsmith.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="vaultsmith-test-")
    s = local_session("*", shuffle_partitions=8, warehouse=os.path.join(scratch, "warehouse"),
                      extra={"spark.sql.shuffle.partitions": "8"})
    checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def scratch_db(spark, request):
    """A fresh database name per test (tables live in the session warehouse)."""
    name = "t_" + request.node.name.lower().replace("[", "_").replace("]", "").replace("-", "_")[:40]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
