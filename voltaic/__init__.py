"""voltaic — utility-grid operations analytics as pure PySpark DataFrame operators.

Layers (medallion): ``sources`` (bronze ingest), ``operators`` (silver curation,
merges, gold marts, data quality), ``streaming`` (Structured Streaming ingest),
``plans`` (the only writer: the end-to-end pipeline and the test-data bindings).

Every operator is a function ``DataFrame(s) -> DataFrame`` built from Spark's own
expressions; none calls an action, so Catalyst sees (and optimizes) the whole plan.
"""

__version__ = "0.1.0"
