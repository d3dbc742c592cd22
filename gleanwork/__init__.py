"""Spark jobs for curating web-collected articles, tool catalogues, crawled pages and profiles."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
