"""Spark-native harvesting of news articles from tables of crawled pages."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need not have this package installed: its functions travel with
# the plan that uses them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
