"""Sensoria: city sensor analytics as Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame.  Nothing here
collects data or writes files unless its name says so (``write_*``,
``publish_*``, ``run_*``).
"""

__version__ = "0.1.0"
