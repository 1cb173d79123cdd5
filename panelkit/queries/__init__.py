"""Named queries; importing this package registers them in ``catalog``."""

from . import (basics, checks_q, coverage_q, features_q, forecast_q, insights_q,  # noqa: F401
               macros_q, models_q, panel_q, series_q, standardize_q, states_q, watch_q)
