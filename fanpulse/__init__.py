"""fanpulse: product analytics for a football app as Spark DataFrame plans.

Operators (``fanpulse.operators``) take DataFrames and column names and return
lazy DataFrames built only from Spark SQL built-ins; ``fanpulse.plans`` composes
them into the marts, report extracts and dashboard queries; ``fanpulse.sources``
reads, ingests and writes tables. See README.md for the inventory and the
scale design.
"""

__version__ = "0.1.0"
