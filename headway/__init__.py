"""headway: transit arrival analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions; nothing iterates over routes, trips or rows on the
driver.
"""

__version__ = "0.1.0"
