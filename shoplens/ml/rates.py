"""Purchase rate by level: the baseline that a trained model has to beat.

``RateEstimator`` learns the share of positives per combination of its columns,
drawn to the overall share by ``prior`` rows.  Fitting is one aggregate and scoring
one join, so it stands for any estimator where results must be checked in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators._util import written


@dataclass(frozen=True)
class RateModel:
    columns: tuple[str, ...]
    rates: DataFrame  # the columns as _0, _1, ... and rate
    overall: DataFrame  # one row: overall

    def pinned(self) -> RateModel:
        """The model as written tables, for a stream that would fit it anew in every batch."""
        return RateModel(self.columns, written(self.rates, "rates"), written(self.overall, "overall"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability``; combinations not seen get the overall share."""
        same = F.lit(True)
        for i, c in enumerate(self.columns):
            same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
        out = df.join(self.rates, same, "left").crossJoin(F.broadcast(self.overall))
        return out.withColumn("probability", F.coalesce("_rate", "_overall")).select(*df.columns, "probability")


@dataclass(frozen=True)
class RateEstimator:
    columns: Sequence[str]
    label: str
    prior: float = 20.0

    def fit(self, train: DataFrame) -> RateModel:
        pos, n = F.sum(F.col(self.label).cast("long")), F.count(self.label)
        overall = train.agg(F.try_divide(pos.cast("double"), n.cast("double")).alias("_overall"))
        counts = train.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(self.columns)]).agg(pos.alias("_pos"), n.alias("_cnt"))
        rate = (F.col("_pos") + F.lit(self.prior) * F.col("_overall")) / (F.col("_cnt") + F.lit(self.prior))
        rates = counts.crossJoin(F.broadcast(overall)).withColumn("_rate", rate).drop("_pos", "_cnt", "_overall")
        return RateModel(tuple(self.columns), rates, overall)
