"""voltaic: hourly electricity-system analytics as Spark DataFrame plans.

Layers follow the lake convention: reports are read into bronze frames,
cleaned and enriched into silver, joined and aggregated into gold, and
served as named queries.  Every operator is a function ``DataFrame ->
DataFrame`` built from Spark SQL expressions, so Catalyst sees one plan.
"""

__all__ = ["config"]
