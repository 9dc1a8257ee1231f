"""cartcast: purchase-forecasting analytics on PySpark.

Plain functions ``DataFrame -> DataFrame`` grouped by concern:

* ``sources``   – readers, writers, text parsers, connector option builders
* ``functions`` – Column expressions (dates, codes, arrays, vectors)
* ``operators`` – relational, horizon, feature, model and metric operators
* ``plans``     – end-to-end jobs composed from the operators
* ``streaming`` – stream transforms written once for batch and stream
* ``suite``     – the registry of named queries and their SQL twins
"""

__all__ = ["session", "tables"]
