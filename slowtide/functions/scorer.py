"""Applying a fitted two-headed linear model as plain columns."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from slowtide.functions.numeric import log_ms_to_ms, sigmoid
from slowtide.functions.plantree import PLAN_FEATURES
from slowtide.functions.text import TEXT_FEATURES

FEATURES = TEXT_FEATURES + PLAN_FEATURES
SAVED = (
    "features array<string>, means array<double>, scales array<double>, slow_weights array<double>, slow_bias double, "
    "log_weights array<double>, log_bias double"
)


@dataclass(frozen=True)
class Scorer:
    """Means and scales from training, one weight per feature and head, and two intercepts."""

    features: list[str]
    means: list[float]
    scales: list[float]
    slow_weights: list[float]
    slow_bias: float
    log_weights: list[float]
    log_bias: float

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the coefficients as one Parquet row, so that training and scoring can be two jobs."""
        spark.createDataFrame([tuple(asdict(self).values())], SAVED).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        return cls(**spark.read.schema(SAVED).parquet(path).first().asDict())

    def _linear(self, weights: list[float], bias: float) -> Column:
        out = F.lit(float(bias))
        for name, mean, scale, weight in zip(self.features, self.means, self.scales, weights, strict=True):
            out = out + (F.col(name).cast("double") - F.lit(float(mean))) / F.lit(float(scale)) * F.lit(float(weight))
        return out

    def p_slow(self) -> Column:
        return sigmoid(self._linear(self.slow_weights, self.slow_bias))

    def predicted_ms(self) -> Column:
        return log_ms_to_ms(self._linear(self.log_weights, self.log_bias))
