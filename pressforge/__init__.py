"""pressforge: Spark-native building, curation and scoring of synthetic
image-caption datasets.

Every operator is a DataFrame-in / DataFrame-out function built from native
Column expressions, joins, aggregations, windows and Structured Streaming.
"""

__version__ = "0.1.0"
