"""tradelake: Spark-native preparation of trade-statistics style reference data.

Every operator is a DataFrame -> DataFrame transformation (or a source that
returns a DataFrame, or a sink that writes one) so Catalyst plans the whole
lineage; see README.md for the operator map.
"""

import sys as _sys

# Functions of this package that run on executors (mapInArrow bodies,
# injected per-request functions) are shipped by value, so executors need
# no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship with --py-files instead
    pass

from tradelake.session import get_session, scratch_path  # noqa: E402

__all__ = ["get_session", "scratch_path"]
