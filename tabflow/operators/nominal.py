"""A stage of MLlib pipelines that numbers categories by a dictionary table.

MLlib's own indexer holds all categories of a column on the driver, in the model and in the metadata of
its output. Here the fitted categories are a written table that scoring joins: the model and the metadata
hold their number alone, so a column may have as many categories as a table has rows.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators.encoding import apply_index, fit_index

DICTIONARY = "feature string, category string, code int"


class _Columns(HasInputCols, HasOutputCols):
    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols()))


class TableIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Codes by frequency, most frequent first and ties in text order; NULL is a category of its own."""

    def __init__(self, columns: list[str] | None = None, outputs: list[str] | None = None) -> None:
        super().__init__()
        if columns is not None:
            self._set(inputCols=columns, outputCols=outputs or [f"{c}_index" for c in columns])

    def _fit(self, dataset: DataFrame) -> "TableIndexerModel":
        columns = self.getInputCols()
        dictionary = fit_index(dataset, columns)
        sizes = dictionary.agg(*[F.count_if(F.col("feature") == c) for c in columns]).first()
        model = TableIndexerModel(dictionary)
        model._set(inputCols=columns, outputCols=self.getOutputCols(), sizes=list(sizes))
        model._resetUid(self.uid)
        return model


class TableIndexerModel(Model, _Columns, MLReadable, MLWritable):
    """Joins the dictionary to the rows of a table or stream; what it does not know is the code after the last."""

    sizes = Param(Params._dummy(), "sizes", "categories of each input column", typeConverter=TypeConverters.toListInt)

    def __init__(self, dictionary: DataFrame | None = None) -> None:
        super().__init__()
        self.dictionary = dictionary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = self.pairs()
        for (column, output), size in zip(pairs, self.getOrDefault(self.sizes)):
            raw = f"{column}_index"
            kept = dataset.columns
            joined = apply_index(dataset, self.dictionary, [column], unseen="null")
            # known and unknown codes, by number: the metadata does not grow with the categories
            nominal = {"ml_attr": {"type": "nominal", "name": output, "num_vals": size + 1}}
            code = F.coalesce(F.col(raw), F.lit(size)).cast("double")
            dataset = joined.select(*[F.col(c) for c in kept if c != output], code.alias(output, metadata=nominal))
        return dataset

    def names(self, suffix: str) -> DataFrame:
        """(position, name): what `<column><suffix>_<code>` stands for, as `<column><suffix>_<category>`."""
        known = self.dictionary.select("feature", "category", "code")
        rows = [(c, "__unknown", n) for c, n in zip(self.getInputCols(), self.getOrDefault(self.sizes))]
        both = known.unionByName(known.sparkSession.createDataFrame(rows, "feature string, category string, code int"))
        stem = F.concat("feature", F.lit(f"{suffix}_"))
        return both.select(F.concat(stem, F.col("code").cast("string")).alias("position"), F.concat(stem, "category").alias("name"))

    def write(self) -> "_Writer":
        return _Writer(self)

    @classmethod
    def read(cls) -> "_Reader":
        return _Reader()


class _Writer(MLWriter):
    """The parameters, and the dictionary as Parquet beside them."""

    def __init__(self, model: TableIndexerModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.dictionary.write.parquet(f"{path}/dictionary")


class _Reader(MLReader):
    def load(self, path: str) -> TableIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableIndexerModel(self.sparkSession.read.schema(DICTIONARY).parquet(f"{path}/dictionary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
