"""Cleaning of newline-delimited JSON record dumps as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors get the few Python helpers (the .zst reader) by value, so a job
# does not depend on the package being installed on every worker.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
