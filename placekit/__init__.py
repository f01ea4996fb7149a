"""placekit: Spark-native place matching and feed consolidation.

Public entry points live in the sub-packages:

* ``placekit.functions``  - column-expression rules (names, streets, geo, states)
* ``placekit.sources``    - landed feed readers, derived fixtures, CSV/parquet sinks
* ``placekit.operators``  - radius join, matcher, consolidation, diffs, reports
* ``placekit.plans``      - end-to-end jobs (sync, comparison) and the query catalog
"""

from placekit.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
