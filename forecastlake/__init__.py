"""forecastlake: forecast-API responses to a queryable Parquet lake, on Spark.

Every public function takes and returns DataFrames (or writes them); nothing
series-sized passes through the driver. Common entry points are re-exported
here; the modules hold the full API.
"""

from forecastlake.operators import quality, state  # noqa: F401
from forecastlake.operators.flatten import flatten_daily, flatten_hourly, flatten_series  # noqa: F401
from forecastlake.operators.parse import parse_responses, split_ok_failed  # noqa: F401
from forecastlake.operators.validate import check_rows  # noqa: F401
from forecastlake.plans.run import run_batch  # noqa: F401
from forecastlake.session import get_spark  # noqa: F401
from forecastlake.sinks.lake import write_forecasts  # noqa: F401
from forecastlake.sources.lake import read_lake, read_legacy_tree  # noqa: F401
from forecastlake.sources.responses import read_responses  # noqa: F401
from forecastlake.sources.state_store import read_state, save_state  # noqa: F401
from forecastlake.streaming.incremental import run_available_now  # noqa: F401

__version__ = "0.1.0"
