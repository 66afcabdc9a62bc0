"""Operators that prepare text corpora for training language models."""

import sys

from pyspark import cloudpickle

# The functions run by tasks travel with them: executors need not find this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
