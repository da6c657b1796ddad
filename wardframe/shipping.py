"""Making the library known to the Python workers."""

from __future__ import annotations

from types import ModuleType

import wardframe
from pyspark import cloudpickle


def ship_by_value(*modules: ModuleType) -> None:
    """Send functions of the library, and of ``modules``, along with the task.

    Needed only where they are not installed on the executors.
    """
    for module in (wardframe, *modules):
        cloudpickle.register_pickle_by_value(module)
