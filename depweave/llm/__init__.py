"""Operators for preparing training text. Nothing else in the library imports this package."""

import os
import sys
from pathlib import Path

from pyspark import cloudpickle

# Python workers import this package from PYTHONPATH or the folder Spark was started in. Where
# neither has it, functions travel to the workers with all they call.
_ROOT = Path(__file__).resolve().parents[2]
_SEEN = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
if _ROOT not in [Path(folder).resolve() for folder in _SEEN if folder]:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
