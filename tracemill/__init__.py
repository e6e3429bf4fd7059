"""tracemill: forensic event extraction and timelines as Spark DataFrame jobs.

Files come in as rows, are unpacked until nothing is packed, matched against
signatures, fanned out to extractors, and leave as event, warning, source,
stream, count and session tables or as JSON documents.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python stages travel to the executors by value, so a cluster needs no copy of
# this package installed on its workers.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
