import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.domain import LOG_SCHEMA  # noqa: E402
from tidemark.session import build_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def change(op, before=None, after=None, lsn=1, ts_ms=1_000):
    """A change envelope as JSON text."""
    payload = {"op": op, "before": before, "after": after, "source": {"lsn": lsn, "ts_ms": ts_ms}, "ts_ms": ts_ms}
    return json.dumps({"payload": payload})


def make_log(spark, topic, values, partition=0, first=0):
    """Log records with consecutive offsets, in the order given."""
    rows = [
        (topic, partition, first + i, datetime(2024, 1, 1, tzinfo=timezone.utc), str(i), value)
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def ordered(data):
    """Sorted, with nulls last."""
    return sorted(data, key=lambda row: [(value is None, value) for value in row])


def rows(df):
    return ordered(tuple(r) for r in df.collect())


def order(order_id=1, status="CREATED", amount="10.00", user=1, created="2024-01-01T00:00:00Z", **more):
    return {"order_id": order_id, "user_id": user, "status": status, "total_amount": amount, "created_at": created, **more}
