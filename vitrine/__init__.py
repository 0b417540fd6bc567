"""vitrine: listing-authenticity analytics as Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` built from native
Spark expressions, SQL, MLlib or Structured Streaming.
"""

__version__ = "0.1.0"
