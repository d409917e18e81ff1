"""tillcast: retail demand analytics and forecasting as Spark DataFrame jobs.

Every operator is ``DataFrame -> DataFrame``, lazy, keyed by item and date,
and never collects facts to the driver.
"""

from tillcast.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
