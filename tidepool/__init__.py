"""tidepool: stream and table analytics operators expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame; planning and execution
are left to Catalyst (batch) and Structured Streaming (streams).
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Ship the library's code with each task (UDFs, foreachBatch functions,
    stateful processors, the Python data source), so Python workers need no
    installed copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
