"""trainloom: post-training data jobs (curation, trajectories, rollout scoring,
evaluation reports) expressed as Spark DataFrame plans."""

import sys as _sys

__version__ = "0.1.0"

# Python UDFs defined here are shipped to executors by value, so workers need
# no installed copy of the package (a cluster may still ship it as py-files).
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
