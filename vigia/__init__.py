"""vigia: a Spark-native warehouse for public-health case notifications.

Layers (all plain DataFrame / SQL work, no engine of its own):

* ``sources``    – reading raw notification files, typing, row ids, warehouse sinks
* ``functions``  – Column-level helpers (dates, text, flags, lookups, formats)
* ``operators``  – DataFrame -> DataFrame rules: cleaning, reshaping, dimensions,
                   facts, data-quality checks, change audit
* ``plans``      – the ETL that builds the warehouse, the analytical views and
                   the dashboard-level aggregates
* ``streaming``  – the change audit as a Structured Streaming job
"""

__version__ = "0.1.0"
