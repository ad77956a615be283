"""Objects of this package for the workers."""

from __future__ import annotations

from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shared:
    """An object of known size, broadcast in a form that workers can read also where they don't
    have this package."""

    def __init__(self, spark: SparkSession, value: Any):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    @property
    def value(self) -> Any:
        if self._value is None:
            self._value = cloudpickle.loads(self._packed.value)
        return self._value

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_value": None}
