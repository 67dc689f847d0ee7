"""playmart: mobile-game analytics marts as PySpark DataFrame jobs.

Layers (each a module of ``DataFrame -> DataFrame`` functions, no actions inside):

* ``sources``   raw feeds (test-table fixtures), Parquet sinks and incremental loads
* ``functions`` Column helpers shared by every layer (safe division, PII hashing, IAP value, ...)
* ``operators`` staging, marts, analytics models, metric recipes, data-quality checks
* ``plans``     the warehouse object that wires the layers together for one input directory
* ``streaming`` Structured Streaming versions of the intraday event load
"""

from playmart.session import AS_OF, get_session

__all__ = ["AS_OF", "get_session"]
