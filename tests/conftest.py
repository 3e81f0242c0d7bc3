import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline import build_session
    s = build_session("local[4]", "ledgerline-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4",
    })
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from ledgerline import scratch_path
    return scratch_path(spark, request.node.name.replace("[", "_").replace("]", ""))
