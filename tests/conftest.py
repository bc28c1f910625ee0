import json
import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecastlake.schemas import RESPONSE  # noqa: E402
from forecastlake.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# A usable body with both blocks, and its location: values of our own.
SAMPLE_BODY = {
    "elevation": 402.0, "latitude": 47.25, "longitude": 8.625, "generationtime_ms": 0.875,
    "timezone": "GMT", "timezone_abbreviation": "GMT", "utc_offset_seconds": 0,
    "hourly": {"precipitation": [0.4, 0.1], "temperature_2m": [11.25, 12.75],
               "time": ["2031-03-07T00:00", "2031-03-07T01:00"]},
    "daily": {"precipitation_sum": [0.5, 0.25], "temperature_2m_min": [9.5, 8.25],
              "temperature_2m_max": [21.5, 19.75], "time": ["2031-03-07", "2031-03-08"]},
}
HARBOUR = ("Harbour", 47.25, 8.625)
INGEST = datetime(2031, 3, 7, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="fl-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from forecastlake.session import scratch_path
    return scratch_path(spark, "test")


def response_row(body, *, location=HARBOUR, interval="hourly", attempt=1, transport_error=None,
                 error_class=None, ingest=INGEST, run_id="test-1", provider="open_meteo"):
    text = body if (body is None or isinstance(body, str)) else json.dumps(body)
    return ({"name": location[0], "latitude": location[1], "longitude": location[2]},
            provider, interval, attempt, text, transport_error, error_class, ingest,
            "https://example.invalid/forecast", 12.5, 200, run_id)


def responses(spark, rows):
    return spark.createDataFrame(rows, RESPONSE)
