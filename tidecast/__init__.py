"""tidecast: point-in-time correct demand-forecasting features, models and
ensembles as Spark DataFrame operators.

Every operator takes and returns DataFrames and is built from Spark SQL
built-ins, so Catalyst can prune, push down and plan it for any scale.
"""

__version__ = "0.1.0"
