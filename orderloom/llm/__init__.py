"""Operators of a training-data pipeline: archives, extraction, language, duplicates, mixing, token files, packing.

Functions that run inside tasks are sent by value, so executors need this package neither installed nor on a path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
