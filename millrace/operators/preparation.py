"""Features prepared as training rows say, as a stage of a pipeline that can be saved.

Numbers: null becomes the median, then the mean is taken off and the deviation of the population divides. Categories:
null counts as UNKNOWN, each category seen in training has an indicator, and one that wasn't gives zeros."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import metrics

UNKNOWN = "UNKNOWN"


class _Columns(Params):
    numbers = Param(Params._dummy(), "numbers", "columns that are filled and scaled", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "columns that become indicators", TypeConverters.toListString)
    most = Param(Params._dummy(), "most", "categories of a column, at most", TypeConverters.toInt)


class Preparation(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, means, deviations and categories. A column with more than `most` categories is an error, not cut short."""

    @keyword_only
    def __init__(self, *, numbers=None, categories=None, most=1000):
        super().__init__()
        self._setDefault(numbers=[], categories=[], most=1000)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> Prepared:
        numbers, categories, most = (self.getOrDefault(p) for p in (self.numbers, self.categories, self.most))
        fitted: dict = {"numbers": {}, "categories": {}}
        if numbers:
            medians = {r["name"]: r["value"] for r in metrics.quantiles(dataset, tuple(numbers), [0.5]).collect()}  # a row per column
            filled = dataset.select(*(F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))).alias(c) for c in numbers))
            moments = filled.agg(*(F.avg(c).alias(f"a{i}") for i, c in enumerate(numbers)), *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numbers))).first()
            fitted["numbers"] = {c: [medians.get(c), moments[f"a{i}"], moments[f"s{i}"] or 1.0] for i, c in enumerate(numbers)}
        for c in categories:
            seen = [r[0] for r in dataset.select(F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))).distinct().limit(most + 1).collect()]
            if len(seen) > most:
                raise ValueError(f"{c} has more than {most} categories")
            fitted["categories"][c] = sorted(seen)
        return self._copyValues(Prepared()._set(fitted=json.dumps(fitted, sort_keys=True)))


class Prepared(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds z_<number> and is_<column>_<category>. What was learned is a parameter, and is saved with the others."""

    fitted = Param(Params._dummy(), "fitted", "medians, means, deviations and categories", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numbers=[], categories=[], most=1000)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))

    def outputs(self) -> list[str]:
        learned = self.learned()
        return [f"z_{c}" for c in learned["numbers"]] + [f"is_{c}_{v}" for c, seen in learned["categories"].items() for v in seen]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = self.learned()
        made = {f"z_{c}": (F.coalesce(F.col(c).cast("double"), F.lit(median)) - F.lit(mean)) / F.lit(deviation) for c, (median, mean, deviation) in learned["numbers"].items()}
        for c, seen in learned["categories"].items():
            value = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
            made |= {f"is_{c}_{v}": (value == v).cast("double") for v in seen}
        return dataset.withColumns(made)
