"""Dropping correlated features as a stage of a pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabloom.operators.association import correlation_matrix


class _CorrelationParams(HasInputCols):
    method = Param(Params._dummy(), "method", "'pearson' or 'spearman'", TypeConverters.toString)
    cutoff = Param(Params._dummy(), "cutoff", "absolute correlation above which the later feature goes, in 0..1", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(method="pearson", cutoff=0.65)


class CorrelationSelector(Estimator, _CorrelationParams, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps each of ``inputCols`` unless its correlation with an earlier kept one is above ``cutoff``.

    Fitted on the training part; the model drops the same columns from any frame. A constant
    feature has no correlation and stays.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, method="pearson", cutoff=0.65):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> "CorrelationSelectorModel":
        names, cutoff, method = self.getInputCols(), self.getOrDefault(self.cutoff), self.getOrDefault(self.method)
        if not 0.0 <= cutoff <= 1.0:
            raise ValueError("cutoff must lie in 0..1")
        matrix = correlation_matrix(dataset.select(*names), names, method)
        kept: list[int] = []
        for i in range(len(names)):
            if not any(abs(matrix[i][j]) > cutoff for j in kept):
                kept.append(i)
        model = CorrelationSelectorModel()
        model._resetUid(self.uid)
        return model._set(inputCols=names, method=method, cutoff=cutoff, kept=[names[i] for i in kept])


class CorrelationSelectorModel(Model, _CorrelationParams, DefaultParamsReadable, DefaultParamsWritable):
    kept = Param(Params._dummy(), "kept", "the features that stay", TypeConverters.toListString)

    def getKept(self) -> list[str]:
        return self.getOrDefault(self.kept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*[c for c in self.getInputCols() if c not in self.getKept()])
