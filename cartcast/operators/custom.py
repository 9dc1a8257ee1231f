"""User-defined pipeline stages (U6, U7), written as Spark ML stages whose
bodies are DataFrame expressions, so they run inside the JVM plan."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, UnaryTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ShiftBy(UnaryTransformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a constant ``shift`` to a double column (persistable, U6).

    ``UnaryTransformer.createTransformFunc`` would be a per-row Python
    function; ``_transform`` is overridden to a native expression instead.
    """

    shift = Param(Params._dummy(), "shift", "value added to the input",
                  typeConverter=TypeConverters.toFloat)

    def __init__(self, shift: float = 0.0):
        super().__init__()
        self._setDefault(shift=0.0)
        self._set(shift=shift)

    def setShift(self, v: float):
        return self._set(shift=v)

    def getShift(self) -> float:
        return self.getOrDefault(self.shift)

    def createTransformFunc(self):  # kept for the API; not used in _transform
        s = self.getShift()
        return lambda x: x + s

    def outputDataType(self):
        return T.DoubleType()

    def validateInputType(self, inputType):
        if not isinstance(inputType, T.NumericType):
            raise TypeError(f"numeric input expected, got {inputType}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.transformSchema(dataset.schema)
        return dataset.withColumn(self.getOutputCol(),
                                  F.col(self.getInputCol()).cast("double") + F.lit(self.getShift()))


class _CentererParams(HasInputCol, HasOutputCol):
    scale = Param(Params._dummy(), "scale", "divide by the sample std as well",
                  typeConverter=TypeConverters.toBoolean)


class MeanCenterer(Estimator, _CentererParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator with its own params (U7): learns the column mean (and std)
    with one aggregate, returns a model that subtracts (and divides)."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None,
                 scale: bool = False):
        super().__init__()
        self._setDefault(scale=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MeanCentererModel":
        c = self.getInputCol()
        row = dataset.agg(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).first()
        model = MeanCentererModel(mean=float(row["m"]),
                                  std=float(row["s"]) if row["s"] else 1.0)
        model._set(inputCol=c, outputCol=self.getOutputCol(),
                   scale=self.getOrDefault(self.scale))
        return model


class MeanCentererModel(Model, _CentererParams, DefaultParamsReadable, DefaultParamsWritable):
    mean = Param(Params._dummy(), "mean", "fitted mean", typeConverter=TypeConverters.toFloat)
    std = Param(Params._dummy(), "std", "fitted sample std", typeConverter=TypeConverters.toFloat)

    def __init__(self, mean: float = 0.0, std: float = 1.0):
        super().__init__()
        self._setDefault(scale=False)
        self._set(mean=mean, std=std)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = F.col(self.getInputCol()).cast("double") - F.lit(self.getOrDefault(self.mean))
        if self.getOrDefault(self.scale):
            x = x / F.lit(self.getOrDefault(self.std))
        return dataset.withColumn(self.getOutputCol(), x)
