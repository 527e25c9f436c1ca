"""Functions for executors that have no copy of this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Send what ``module`` defines with the tasks that use it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
