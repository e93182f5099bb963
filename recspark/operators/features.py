"""Feature specification and a fit/transform bundle whose state is a set of tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import pad
from ..functions.text import words
from .encoding import encode, feature_dictionary, fit_dictionary
from .scaling import fit_standard, standard_scale
from .sequences import fit_vocabulary, history_codes, longest, sequence_ids


@dataclass
class FeatureSpec:
    """Names of the columns by role; `histories` maps a history to its main column."""

    key: str
    dense: Sequence[str] = ()
    sparse: Sequence[str] = ()
    sequences: Sequence[str] = ()
    histories: dict[str, str] = field(default_factory=dict)
    separator: str = ","
    history_length: int = 5


@dataclass
class FeatureProcessor:
    """Scaler, dictionaries and vocabularies, fitted once and shared by training and serving."""

    spec: FeatureSpec
    scaler: DataFrame | None = None
    dictionary: DataFrame | None = None
    vocabularies: dict[str, DataFrame] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)

    def _tokens(self, name: str):
        return words(F.col(name), self.spec.separator)

    def fit(self, df: DataFrame) -> FeatureProcessor:
        spec = self.spec
        if spec.dense:
            self.scaler = fit_standard(df, spec.dense)
        if spec.sparse:
            self.dictionary = fit_dictionary(df, spec.sparse)
        for name in spec.sequences:
            self.vocabularies[name] = fit_vocabulary(df, self._tokens(name), [spec.key])
            self.lengths[name] = longest(df.select(self._tokens(name).alias("t")), "t")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Scaled, coded and padded columns under the same names, one row per input row."""
        spec = self.spec
        lists = {}
        for name in spec.sequences:
            ids = sequence_ids(df, [spec.key], self._tokens(name), self.vocabularies[name], 1)
            lists[name] = ids.select(spec.key, pad(F.col("ids"), self.lengths[name]).alias(name))
        for name, main in spec.histories.items():
            values = feature_dictionary(self.dictionary, main)
            lists[name] = history_codes(
                df, [spec.key], name, values, spec.history_length, spec.separator
            )
        out = df.drop(*lists)
        if spec.dense:
            out = standard_scale(out, self.scaler)
        if spec.sparse:
            out = encode(out, self.dictionary, spec.sparse)
        for ids in lists.values():
            out = out.join(ids, spec.key)
        return out.select(*df.columns)

    def feature_spec(self) -> DataFrame:
        """Rows `(kind, feat, feat_num, shared_with, shared_index)` for the model builder; the
        index is the place of a history's main column among the sparse ones."""
        spec, spark = self.spec, (self.dictionary or self.scaler).sparkSession
        rows = [("dense", name, None, None, None) for name in spec.dense]
        if spec.sparse:
            sizes = self.dictionary.groupBy("feature").count().collect()  # one row per feature
            counts = {r["feature"]: r["count"] for r in sizes}
            rows += [("sparse", name, counts[name], None, None) for name in spec.sparse]
        # words and OOV have an id each, 0 is padding
        rows += [("sequence", n, self.vocabularies[n].count() + 1, None, None) for n in spec.sequences]
        place = {name: i for i, name in enumerate(spec.sparse)}
        rows += [("history", n, None, main, place[main]) for n, main in spec.histories.items()]
        schema = "kind string, feat string, feat_num long, shared_with string, shared_index int"
        return spark.createDataFrame(rows, schema)

    def save(self, path: str) -> None:
        """Write all fitted tables below `path`."""
        if self.scaler is not None:
            self.scaler.write.parquet(f"{path}/scaler")
        if self.dictionary is not None:
            self.dictionary.write.partitionBy("feature").parquet(f"{path}/dictionary")
        for name, table in self.vocabularies.items():
            table.withColumn("length", F.lit(self.lengths[name])).write.parquet(
                f"{path}/vocabulary_{name}"
            )

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec) -> FeatureProcessor:
        loaded = cls(spec)
        if spec.dense:
            loaded.scaler = spark.read.parquet(f"{path}/scaler")
        if spec.sparse:
            schema = "number long, value string, code long, n long, feature string"
            loaded.dictionary = spark.read.schema(schema).parquet(f"{path}/dictionary")
        for name in spec.sequences:
            table = spark.read.parquet(f"{path}/vocabulary_{name}")
            loaded.lengths[name] = table.first()["length"]
            loaded.vocabularies[name] = table.drop("length")
        return loaded
