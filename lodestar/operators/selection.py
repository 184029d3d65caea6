"""χ² term selection as a ``pyspark.ml`` estimator without a vocabulary of all terms.

``TermSelector`` counts terms in a distributed job, ranks them by χ² against the label and keeps the
best; only these reach the driver. Its model turns a column of tokens into count vectors over the
kept terms. Both are ordinary stages: they work in a ``Pipeline``, in a parameter grid, and save and load.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .terms import chi2_overall, chi2_top_terms_overall

# executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TERMS = "position int, term string, df long, chi2 double, dof long"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: of a batch of labels and token lists, the rows of each label that have a term so often."""
    for batch in batches:
        label = batch.column("label").dictionary_encode()
        tokens = batch.column("tokens")
        term = tokens.flatten().dictionary_encode()
        if not len(term):
            continue
        row = np.repeat(np.arange(len(batch), dtype=np.int64), np.diff(tokens.offsets.to_numpy()))
        n_terms = len(term.dictionary)
        pair, tf = np.unique(row * n_terms + term.indices.to_numpy(), return_counts=True)
        row, code = np.divmod(pair, n_terms)
        most = int(tf.max()) + 1  # a cell's number is below rows x tokens of a batch
        cell, n = np.unique((label.indices.to_numpy()[row] * n_terms + code) * most + tf, return_counts=True)
        of, tf = np.divmod(cell, most)
        of, code = np.divmod(of, n_terms)
        yield pa.RecordBatch.from_arrays(
            [label.dictionary.take(pa.array(of)), term.dictionary.take(pa.array(code)),
             pa.array(tf, pa.int64()), pa.array(n, pa.int64())], ["label", "term", "tf", "n"])


def ranked_terms(rows: DataFrame, tokens_col: str, label_col: str, k: int, by: str) -> DataFrame:
    """The best ``k`` terms of ``rows`` with their statistics; rows need no id.

    Rows with a null label are left out. A row's tokens are counted inside the row, and a batch's rows are counted
    by label, term and number of occurrences before they leave the task.
    """
    known = rows.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).alias("label"), F.array_compact(tokens_col).alias("tokens"))
    schema = T.StructType([known.schema["label"], T.StructField("term", T.StringType()),
                           T.StructField("tf", T.LongType()), T.StructField("n", T.LongType())])
    counts = known.where(F.size("tokens") > 0).mapInArrow(_cells, schema)
    return chi2_top_terms_overall(chi2_overall(counts, known, "label", F.sum("n")), k, by)


class _Selection(HasInputCol, HasLabelCol, HasOutputCol):
    numTop = Param(Params._dummy(), "numTop", "terms to keep", typeConverter=TypeConverters.toInt)
    rankBy = Param(Params._dummy(), "rankBy", "chi2: the statistic, p: the p-value",
                   typeConverter=TypeConverters.toString)

    def _own_defaults(self):
        self._setDefault(numTop=4000, rankBy="p", labelCol="label", outputCol="selectedTerms")


class TermSelector(Estimator, _Selection, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the ``numTop`` terms of ``inputCol``, a column of tokens, that tell most about ``labelCol``."""

    @keyword_only
    def __init__(self, *, inputCol=None, labelCol=None, outputCol=None, numTop=None, rankBy=None):
        super().__init__()
        self._own_defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TermSelectorModel:
        best = ranked_terms(dataset, self.getInputCol(), self.getLabelCol(), self.getOrDefault("numTop"),
                            self.getOrDefault("rankBy"))
        rows = [(k, r["term"], r["df"], r["chi2"], r["dof"]) for k, r in enumerate(best.collect())]
        return self._copyValues(TermSelectorModel(rows).setParent(self))


class TermSelectorModel(Model, _Selection, MLReadable, MLWritable):
    """Counts of the kept terms as sparse vectors; ``terms`` lists them, the best first."""

    def __init__(self, rows: list[tuple] | None = None):
        super().__init__()
        self._own_defaults()
        self._rows = rows or []

    @property
    def terms(self) -> list[str]:
        return [r[1] for r in self._rows]

    def selected(self, spark: SparkSession) -> DataFrame:
        """The kept terms with position and statistics, as a table to write or join."""
        return spark.createDataFrame(self._rows, TERMS)

    def setParent(self, parent: Estimator) -> TermSelectorModel:
        self._resetUid(parent.uid)
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        counter = CountVectorizerModel.from_vocabulary(
            self.terms or [""], inputCol=self.getInputCol(), outputCol=self.getOutputCol())
        return counter.transform(dataset)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    """Parameters as metadata, terms as Parquet beside them."""

    def __init__(self, model: TermSelectorModel):
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession)
        self._model.selected(self.sparkSession).coalesce(1).write.parquet(os.path.join(path, "terms"))


class _ModelReader(MLReader):
    def load(self, path: str) -> TermSelectorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stored = self.sparkSession.read.schema(TERMS).parquet(os.path.join(path, "terms"))
        model = TermSelectorModel([tuple(r) for r in stored.orderBy("position").collect()])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
