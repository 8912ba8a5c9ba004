"""clickpath: clickstream sessionization, purchase prediction and monitoring on Spark.

Sub-packages:
    sources    typed scans, JSON decode/encode, the Parquet event lake
    functions  column expressions (sanitizing, time parsing, encoding)
    operators  sessions, metrics, registry and monitor operators
    plans      the training cycle and the registered query builders
    streaming  archive and scoring Structured Streaming queries
"""

__version__ = "0.1.0"
