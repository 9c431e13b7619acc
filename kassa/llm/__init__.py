"""Operators for building training data at corpus scale, one module each.

Nothing outside this folder imports it. ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task: executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
