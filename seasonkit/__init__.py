"""seasonkit: play-event analytics and season-outcome models on Spark.

Modules: ``sources`` (scans/sinks), ``functions`` (column expressions),
``operators`` (relational and evaluation operators), ``plans`` (learners and
the multi-model leaderboard), ``streaming`` (incremental season ingest).
"""

__version__ = "0.1.0"
