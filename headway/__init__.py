"""headway: transit delay analytics on Apache Spark.

Batch views, a Structured Streaming speed layer and a serving merge, built
from DataFrame operators; see README.md for the layout.
"""

__version__ = "0.1.0"
