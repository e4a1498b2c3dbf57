"""Hand the package's code to Python workers where it is not installed."""

from pyspark import cloudpickle

import tickloom


def ship() -> None:
    """Send the package's functions and classes along with the plans that use them.

    Files added to a session do not reach the worker that starts a stateful query; code that is
    part of the plan does.
    """
    cloudpickle.register_pickle_by_value(tickloom)
