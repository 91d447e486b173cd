"""Operators of a training-data pipeline: tokens, copies, personal data, licences, scores, rules, mixtures."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with their tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
