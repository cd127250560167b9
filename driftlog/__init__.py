"""driftlog: event-log enrichment and activity metrics on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions that run unchanged
on batch and streaming input unless their docstring says otherwise.
"""

__version__ = "0.1.0"
