"""chartlake: popularity-chart snapshots on Spark.

Raw chart and artist documents -> (tracks, artists, track_genres) snapshots
-> read queries, all as DataFrame plans of built-in expressions.

Modules: ``functions`` (Column functions), ``operators`` (DataFrame
operators), ``sources`` (landing zone and warehouse storage), ``plans``
(transforms, read queries, the one-run job, the registered queries),
``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
