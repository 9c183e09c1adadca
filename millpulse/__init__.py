"""millpulse: plant telemetry analytics as Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function, no actions inside):

* ``sources``   raw parquet reads with declared schemas, year paths, source checks,
                and role views that shape the driver's test tables like the plant data
* ``operators`` cleaning (raw -> typed), staging, enrichment joins, the interval join,
                data-quality checks
* ``plans``     the three marts, dashboard aggregates and the yearly load/rebuild job
* ``sinks``     idempotent partitioned writes
* ``functions`` small column-expression helpers (rounding, safe division, time maths)
"""

__version__ = "0.1.0"
