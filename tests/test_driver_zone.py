"""Reports don't depend on the time zone of the driver's operating system."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import hashlib, sys
sys.path.insert(0, %r)
from dialtone.catalog.queries import queries
from dialtone.operators.spine import hour_spine
from dialtone.session import build_session
spark = build_session("local[4]", shuffle_partitions=4)
spark.sparkContext.setLogLevel("OFF")
text = ""
for name in ("scan_cdr_range", "hourly_call_summary", "agent_productivity", "agent_events_all", "call_performance"):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    text += name + str(sorted(map(str, df.collect())))
text += str(hour_spine(spark, "2024-01-01 00:00:00", "2024-01-01 05:00:00").collect())
print("DIGEST", hashlib.sha256(text.encode()).hexdigest())
""" % REPO


def _digest(zone: str) -> str:
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=os.environ | {"TZ": zone}, capture_output=True,
                         text=True, timeout=280)
    found = [line.split()[1] for line in out.stdout.splitlines() if line.startswith("DIGEST")]
    assert found, out.stderr[-2000:]
    return found[0]


@pytest.fixture(scope="module")
def utc():
    return _digest("UTC")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Colombo"])
def test_same_rows_in_every_driver_zone(utc, zone):
    assert _digest(zone) == utc
