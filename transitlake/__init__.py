"""Spark-native analytics for public-transport operations.

Every building block is a ``DataFrame -> DataFrame`` or ``Column -> Column``
function; Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
