"""slotwise — a Spark-native pipeline for streaming-TV ad beacons.

Layers (all DataFrame -> DataFrame, I/O kept at the edges):

* ``functions``  contract constants, validation rules, money / rate / format Columns
* ``sources``    fixture mapping from the test tables, lake layout and readers
* ``operators``  landing, silver dedup, gold marts, quality gate, read queries
* ``plans``      day / range flows and incremental (partition-overwrite) writes
* ``streaming``  Structured Streaming landing, last-write-wins repair, rolling counts
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
