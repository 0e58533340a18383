"""Spark ML stages whose statistics are exact; fitted state lives in params, so the built-in
pipeline persistence saves and reloads them."""

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.connection import network_features
from tidewatch.operators.ranking import exact_quantiles
from tidewatch.operators.select import REPORT_SCHEMA, numeric_columns, select_columns
from tidewatch.schemas import CATEGORICAL


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns the stage works on",
                      typeConverter=TypeConverters.toListString)

    def columns(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    pass


class NetworkFeatures(Transformer, _Columns, _Saved):
    """Target-free engineering; other columns are passed through."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw = self.columns()
        return network_features(df, raw, [c for c in df.columns if c not in raw])


class CorrelationSelector(Estimator, _Columns, _Saved):
    threshold = Param(Params._dummy(), "threshold", "absolute rank correlation that is redundant",
                      typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, threshold=0.90):
        super().__init__()
        self._setDefault(threshold=0.90)
        self._set(threshold=threshold)
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> "CorrelationSelectorModel":
        kept, report, medians = select_columns(df, self.columns(), self.getOrDefault(self.threshold))
        numeric = [c for c in kept if c in numeric_columns(df, kept)]
        return CorrelationSelectorModel(
            inputCols=self.columns(), selected=kept, numeric=numeric,
            medians=[float(medians.get(c, 0.0)) for c in numeric],
            report=[json.dumps(row) for row in report])


class CorrelationSelectorModel(Model, _Columns, _Saved):
    """Frozen selection and training medians."""

    selected = Param(Params._dummy(), "selected", "kept columns",
                     typeConverter=TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "kept numeric columns",
                    typeConverter=TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "training medians of the numeric columns",
                    typeConverter=TypeConverters.toListFloat)
    report = Param(Params._dummy(), "report", "removed columns with the reason, one JSON row each",
                   typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, selected=None, numeric=None, medians=None, report=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def selected_features(self) -> list[str]:
        return list(self.getOrDefault(self.selected))

    def categorical_features(self) -> list[str]:
        return [c for c in self.selected_features() if c in CATEGORICAL]

    def numeric_features(self) -> list[str]:
        return list(self.getOrDefault(self.numeric))

    def report_frame(self, spark) -> DataFrame:
        rows = [tuple(json.loads(r)) for r in self.getOrDefault(self.report)]
        return spark.createDataFrame(rows, REPORT_SCHEMA)

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = dict(zip(self.numeric_features(), self.getOrDefault(self.medians), strict=True))
        kept, gone = self.selected_features(), set(self.columns()) - set(self.selected_features())
        return df.select(*[
            F.coalesce(present(c), F.lit(fill[c])).alias(c)
            if c in fill and c in kept else F.col(f"`{c}`")
            for c in df.columns if c not in gone])


def present(column: str) -> Column:
    """The value as a double; NaN, which files written from pandas hold, counts as missing."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None))


def _medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    if not cols:
        return {}
    found = {r["feature"]: r["m"] for r in exact_quantiles(df, cols, {"m": 0.5}).collect()}
    return {c: float(found.get(c, 0.0)) for c in cols}


class MedianImputer(Estimator, _Columns, _Saved):
    """Exact medians; a column without values is filled with 0."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> "AffineModel":
        cols = self.columns()
        med = _medians(df, cols)
        return AffineModel(inputCols=cols, fill=[med[c] for c in cols],
                           center=[0.0] * len(cols), scale=[1.0] * len(cols))


class PopStandardScaler(Estimator, _Columns, _Saved):
    """(x - mean) / population deviation, zero deviation counts as 1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> "AffineModel":
        cols, row = self.columns(), {}
        # few columns at a time: an aggregation of hundreds of fields isn't compiled
        for start in range(0, len(cols), 16):
            part = list(enumerate(cols))[start:start + 16]
            row |= df.agg(*[F.avg(present(c)).alias(f"m{i}") for i, c in part],
                          *[F.stddev_pop(present(c)).alias(f"s{i}")
                            for i, c in part]).first().asDict()
        return AffineModel(
            inputCols=cols, fill=[], center=[row[f"m{i}"] or 0.0 for i in range(len(cols))],
            scale=[row[f"s{i}"] or 1.0 for i in range(len(cols))])


class ExactRobustScaler(Estimator, _Columns, _Saved):
    """(x - median) / interquartile range, zero range counts as 1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> "AffineModel":
        cols = self.columns()
        q = {r["feature"]: r for r in exact_quantiles(
            df, cols, {"q25": .25, "q50": .5, "q75": .75}).collect()}
        return AffineModel(
            inputCols=cols, fill=[], center=[q[c]["q50"] if c in q else 0.0 for c in cols],
            scale=[(q[c]["q75"] - q[c]["q25"]) or 1.0 if c in q else 1.0 for c in cols])


class AffineModel(Model, _Columns, _Saved):
    """Per-column fill, shift and scale, in place; what is missing and not filled is null."""

    fill = Param(Params._dummy(), "fill", "values for missing entries",
                 typeConverter=TypeConverters.toListFloat)
    center = Param(Params._dummy(), "center", "subtracted", typeConverter=TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "divisor", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, fill=None, center=None, scale=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.columns()
        fill, center, scale = (self.getOrDefault(p) for p in (self.fill, self.center, self.scale))
        out = {}
        for i, c in enumerate(cols):
            x = present(c)
            if fill:
                x = F.coalesce(x, F.lit(fill[i]))
            if center[i] != 0.0:
                x = x - F.lit(center[i])
            out[c] = x / F.lit(scale[i]) if scale[i] != 1.0 else x
        return df.withColumns(out)
