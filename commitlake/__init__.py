"""commitlake: Spark-native analytics over JSON-enveloped source-control records.

Layers (each a plain DataFrame/Column API, no Python UDFs on any hot path):

* ``sources``   raw envelope schema, raw scans, landing writers, fixture streams
* ``functions`` Column-level helpers (JSON scalars, safe casts, classifiers, dates, rates)
* ``operators`` reusable DataFrame operators (keep-latest, modes, global rank,
                incremental upsert, data-quality assertions)
* ``plans``     the nine models (four staging tables, five marts)
* ``streaming`` file-stream variant of the incremental load
"""

from commitlake.session import build_session, configure, shared_dir  # noqa: F401
