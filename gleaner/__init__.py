"""gleaner: DataFrame operators for data harvested from the web.

``functions``  column expressions (URLs, content kinds, patterns, chunks)
``sources``    readers for input lists, payload folders, manifests, sitemaps, logs
``operators``  DataFrame -> DataFrame operators (shredding, path steps, export, links, ledger)
``streaming``  Structured Streaming forms of the ledger and export operators
``plans``      the registered queries, each next to its oracle SQL
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
