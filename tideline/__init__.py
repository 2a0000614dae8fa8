"""Panel time-series and regime analytics on Spark DataFrames.

A *panel* is a table with one row per (entity, time). Every operator takes and
returns DataFrames; nothing here runs a job unless its name says so (``fit_*``,
``write_*``, ``save_*``, ``run_*``).
"""

from tideline.settings import FEATURES, REGIMES
from tideline.operators.layout import Axis

__all__ = ["Axis", "FEATURES", "REGIMES"]
