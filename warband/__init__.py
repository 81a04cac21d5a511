"""warband — match-event analytics on Spark.

Layers: ``sources`` (XES logs, parquet tables, the events adapter), ``plans``
(silver, gold, analyst and discovery jobs), ``operators`` (sequence, MinHash/LSH,
leader, similarity and DBSCAN building blocks), ``functions`` (column
expressions), ``streaming`` (incremental XES ingest).
"""

__version__ = "0.1.0"
