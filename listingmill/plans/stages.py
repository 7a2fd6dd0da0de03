"""Own stages of stored pipelines: they are saved by their parameters and loaded by their class, as Spark's are."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PoolVectors(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The element-wise mean of a row's vectors, ``width`` wide.

    The input is an array of number arrays.  Null vectors do not count; a row without any gets zeros, which also fill up
    vectors that are too short; elements beyond ``width`` and null elements count as nothing.
    """

    width = Param(Params._dummy(), "width", "length of the mean", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, width: int | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kind = F.coalesce(F.col(self.getInputCol()).cast("array<array<double>>"), F.array().cast("array<array<double>>"))
        vectors = F.filter(kind, lambda v: v.isNotNull())
        zeros = F.array_repeat(F.lit(0.0), self.getOrDefault(self.width))
        sums = F.aggregate(vectors, zeros, lambda a, v: F.transform(a, lambda x, i: x + F.coalesce(F.get(v, i), F.lit(0.0))))
        count = F.greatest(F.size(vectors), F.lit(1)).cast("double")
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.transform(sums, lambda x: x / count)))


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Leaves out columns that earlier stages only made for later ones; absent ones are no error."""

    columns = Param(Params._dummy(), "columns", "columns to leave out", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault(self.columns))
