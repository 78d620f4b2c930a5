"""nightjar: fleet location analytics as Spark DataFrame operators.

Night parking spots, charging places, geocoded loan addresses and the daily
per-vehicle report, written as lazy ``DataFrame -> DataFrame`` functions that
Catalyst plans and AQE re-plans at run time.
"""

__version__ = "0.1.0"
