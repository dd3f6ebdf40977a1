"""ledgerline: multi-vendor order analytics as plain Spark DataFrame jobs.

Layers
------
* ``sources``    - vendor file readers (comma / pipe / tab+JSON), lineage columns,
                   header-drift handling, replay guard, test-data feeds.
* ``functions``  - Column helpers: money text parsing, FX, mappings, rank keys.
* ``operators``  - DataFrame -> DataFrame jobs: normalise, dedup, gold aggregates,
                   keyed upsert, maintenance reports, data-quality counts.
* ``plans``      - end-to-end Bronze -> Silver -> Gold wiring and snapshot tables.
* ``streaming``  - incremental (watermark / micro-batch) maintenance of Silver and Gold.

Every function takes and returns DataFrames; nothing is collected to the driver except
bounded metadata (distinct CSV header lines, snapshot version numbers, quantile bounds).
"""

__version__ = "0.1.0"
