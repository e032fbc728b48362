"""newsmetrics: news-collection data pipeline and its quality metrics on Spark.

Every operator is a lazy DataFrame transformation; nothing is collected to the
driver. Sub-packages:

* ``functions``  column expressions (dates, urls, text, numbers, json)
* ``sources``    readers and writers (snapshots, logs, crawl CSV, pages, upsert)
* ``operators``  DataFrame -> DataFrame operators (metrics, links, extraction,
                 progress, control, document)
* ``plans``      registered queries over the driver tables and their SQL oracles
* ``streaming``  Structured Streaming forms of the log router and live progress
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the Python workers by value: a cluster
# needs neither --py-files nor an installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
