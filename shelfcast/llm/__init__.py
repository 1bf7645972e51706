"""Operators for preparing training text: search, duplicates, decontamination, archives, mixing and labels."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
