"""sluice: config-driven incremental table extraction on Spark.

A control row names a source table, a load strategy and a watermark; sluice
turns it into one lazy DataFrame plan (typed predicates, optional
primary-key de-duplication, an EXTRACT_DATE stamp) and one Parquet write whose
row counts are observed in the same pass.  The control-table operations that
surround a copy (config lookup, audit header and line, restart gate,
watermark advance, extraction log) are DataFrame transformations over all
configurations at once.

Layout:

* ``functions``  - Column builders: delta predicates, time formats, keys.
* ``sources``    - Parquet and JDBC readers, control-table schemas.
* ``operators``  - partition discovery, dedup, counts, sinks, watermark,
                   config, audit and restart operators.
* ``plans``      - the nine load strategies and the extraction plan.
"""

from sluice.plans.strategy import LoadStrategy
from sluice.plans.extract import ExtractionConfig, Source, plan_extraction, run_extraction
from sluice.plans.job import ControlTables, run_requests

__all__ = [
    "LoadStrategy",
    "ExtractionConfig",
    "Source",
    "plan_extraction",
    "run_extraction",
    "ControlTables",
    "run_requests",
]
