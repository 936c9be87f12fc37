"""Rule on one feature: a spike is a value more than k standard deviations above the mean."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MODEL_TYPE = "zscore"
PARAMS = "model_type string, feature string, threshold double, mean double, std double"


@dataclass
class ZScoreModel:
    feature: str = "midprice_return_std"
    threshold: float = 2.0
    mean: float | None = None
    std: float | None = None

    @property
    def _fitted(self) -> "ZScoreModel":
        if self.mean is None or self.std is None:
            raise ValueError("the z-score model must be fitted first")
        return self

    def cut(self) -> float:
        m = self._fitted
        return m.mean + m.threshold * m.std

    def decision(self) -> Column:
        """Standard deviations above the cut."""
        m = self._fitted
        z = (F.col(m.feature) - F.lit(m.mean)) / F.lit(m.std + 1e-10)
        return z - F.lit(float(m.threshold))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``predicted_label`` and ``spike_probability``."""
        above = (F.col(self.feature) > F.lit(self.cut())) & ~F.isnan(self.feature)
        return df.withColumns(
            {
                "predicted_label": F.coalesce(above.cast("int"), F.lit(0)),
                "spike_probability": 1.0 / (1.0 + F.exp(-self.decision())),
            }
        )

    def params(self, spark: SparkSession) -> DataFrame:
        row = (MODEL_TYPE, self.feature, float(self.threshold), self.mean, self.std)
        return spark.createDataFrame([row], PARAMS)


def fit_zscore(df: DataFrame, feature: str = "midprice_return_std", threshold: float = 2.0) -> ZScoreModel:
    """Mean and population std of one feature, from one aggregation."""
    if feature not in df.columns:
        raise ValueError(f"feature {feature!r} is not among {df.columns}")
    mean, std = df.agg(F.avg(feature), F.stddev_pop(feature)).first()
    return ZScoreModel(feature, threshold, mean, std)
