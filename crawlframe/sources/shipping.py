"""Send the Python helpers of this package along with the tasks that use them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module_name: str) -> None:
    """Pickle a module's functions by value: executors need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
