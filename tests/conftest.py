import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import CHECKPOINT_DIR, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get(CHECKPOINT_DIR, None) is None:
        session.conf.set(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def new_path(spark):
    from tidemark.session import scratch_dir

    return lambda label="test": scratch_dir(spark, label)


@pytest.fixture
def low_join_limits(spark):
    """No broadcasts, and a skew threshold that small data can pass."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)
