"""Operators of a training-data pipeline; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Python helpers travel to the workers with the tasks, so executors need no copy of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
