"""tabulon: tabular analytics and supervised learning kept on Spark.

Every public function takes and returns DataFrames (or fitted MLlib models); nothing
collects a table to the driver. Sub-packages:

* ``sources``    read tables, inline rows, CSV with explicit schema, bounded exports,
                 model save/load in the shared folder.
* ``functions``  column expressions (CASE encoders, rounding, hash buckets).
* ``operators``  projections, joins, profiling, dedup, ordering, feature recipes,
                 splits, models, tuning, metrics, Shapley attribution, scoring.
* ``plans``      plan inspection helpers (``explain`` text, node checks).
* ``streaming``  the scoring operator applied to a file stream.
* ``catalog``    registered queries and their DuckDB oracles.
"""

import sys

from pyspark import cloudpickle

from tabulon.session import build_session, shared_path

# functions that run in Python workers travel with their code: a cluster's workers need
# numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_path"]
