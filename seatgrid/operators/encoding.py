"""One-hot encoding of categorical columns ranked by label frequency.

All columns are counted in one aggregate; the labels are ranked by a distributed sort and joined back by
equality, at every size. Spark broadcasts a column's labels when their measured size allows. What was fitted is a stored table, so that
an encoder outlives its frame and gives rows that come later the same slots.

The encoded vectors come in two forms, chosen by the caller: ``pyspark.ml`` vectors, whose metadata holds one number
for their length, and slot numbers (``array<int>``), which need nothing on the driver but one count per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.operators.joins import SALT, keyed_join
from seatgrid.session import scratch_path

DEFAULT_COLUMNS = ["Home_Team_Id", "Away_Team_Id", "sectionId", "DayofWeek", "GameTime"]


def label_frequencies(df: DataFrame, columns: Sequence[str], weight: Column | None = None) -> DataFrame:
    """``position, label, n``: how often each label of each column occurs.

    A column counts only the rows in which no earlier column is null, since those rows are dropped before
    it is ranked. ``weight`` is the number of rows that one row of ``df`` stands for.
    """
    entries = []
    for position, name in enumerate(columns):
        label = F.col(name).cast("string")
        for earlier in columns[:position]:
            label = F.when(F.col(earlier).isNotNull(), label)
        entries.append(F.struct(F.lit(position).alias("position"), label.alias("label")))
    weight = F.lit(1) if weight is None else weight
    long = df.select(weight.cast("bigint").alias("weight"), F.explode(F.array(*entries)).alias("entry"))
    return (
        long.filter(F.col("entry.label").isNotNull())
        .groupBy(F.col("entry.position").alias("position"), F.col("entry.label").alias("label"))
        .agg(F.sum("weight").alias("n"))
    )


def rank_labels(frequencies: DataFrame, stage: str | None = None) -> DataFrame:
    """Adds ``label_index``: 0 for the most frequent label of its column, ties in label order.

    A total sort numbers the rows inside each sorted partition; the numbers of rows before each partition
    and each column are then added from two tiny tables, one row per partition and one per column. The numbered
    rows are stored under ``stage``, a shared folder, by default in the session's.
    """
    spark = frequencies.sparkSession
    ordered = frequencies.orderBy("position", F.col("n").desc(), "label")
    numbered = ordered.withColumn("_row", F.monotonically_increasing_id())
    path = f"{stage.rstrip('/')}/labels" if stage else scratch_path(spark, "labels")
    numbered.write.parquet(path)
    # Stored once: a second run of the sort may cut its partitions elsewhere and number the rows differently.
    stored = spark.read.schema(numbered.schema).parquet(path).withColumn("_part", F.shiftright("_row", 33))

    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_part").alias("_start_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    per_column = stored.groupBy("position").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_column.select(
        F.col("position").alias("_position"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_first")
    )
    in_part = F.col("_row") - F.shiftleft(F.col("_part"), 33)
    return (
        # At most one row per shuffle partition, and one per column.
        stored.join(F.broadcast(starts), F.col("_part") == F.col("_start_part"))
        .join(F.broadcast(firsts), F.col("position") == F.col("_position"))
        .select(
            "position", "label", "n",
            (F.col("_start") + in_part - F.col("_first")).cast("double").alias("label_index"),
        )
    )


def _indexed(name: str) -> str:
    return f"{name}_indexed"


def _encoded(name: str) -> str:
    return f"{name}_indexed_encoded"


def label_counts(df: DataFrame, columns: Sequence[str]) -> list[int]:
    """How many labels each indexed column has, from its metadata."""
    return [df.schema[_indexed(name)].metadata["ml_attr"]["num_vals"] for name in columns]


UNSEEN = ("skip", "keep", "error")
FEW_LABELS = 100_000


@dataclass
class FittedEncoder:
    """The labels of ``columns`` and their indexes, with a rule for values that are none of them (null is none, too).

    ``skip`` drops their rows, ``keep`` gives them one more index after the last label's, ``error`` fails on the first one.
    ``labels`` is a stored table of ``position, label, n, label_index``; ``sizes`` counts the labels of each column.
    """

    columns: list[str]
    labels: DataFrame
    sizes: list[int]
    unseen: str = "skip"

    def few_labels(self, columns: Sequence[str]) -> bool:
        """Whether the labels of each of the columns can go to every task, with rows staying where they are."""
        return all(self.sizes[self.columns.index(name)] <= FEW_LABELS for name in columns)

    def attach(
        self, df: DataFrame, columns: Sequence[str] | None = None, salt: int = SALT, in_place: bool = False
    ) -> DataFrame:
        """Adds ``<column>_indexed`` for some of the columns, null for a value without a label; keeps every row.

        A column may get its index in a frame where it is constant over many later rows, and :meth:`settle` the rule at the end.
        ``in_place`` keeps the rows in their partitions, for columns with :meth:`few_labels`.
        """
        result = df
        for name in self.columns if columns is None else columns:
            lookup = self.labels.filter(F.col("position") == self.columns.index(name)).select(
                F.col("label").alias("_label"), F.col("label_index").alias(_indexed(name))
            )
            if in_place:
                lookup, salt = F.broadcast(lookup), 1
            valued = result.withColumn("_value", F.col(name).cast("string"))
            result = keyed_join(valued, lookup, "_value", "_label", "left_outer", salt).drop("_value", "_label")
        return result

    def settle(self, df: DataFrame) -> DataFrame:
        """Applies the rule to attached indexes and notes in their metadata how many there are, as ``pyspark.ml`` reads it.

        That is 1 for a column without any label, which leaves no row (or only kept ones).
        """
        if self.unseen not in UNSEEN:
            raise ValueError(f"unseen is one of {', '.join(UNSEEN)}, not {self.unseen!r}")
        result = df
        for name, size in zip(self.columns, self.sizes):
            index = F.col(_indexed(name))
            if self.unseen == "skip":
                result = result.filter(index.isNotNull())
            elif self.unseen == "keep":
                result = result.withColumn(_indexed(name), F.coalesce(index, F.lit(float(size))))
            else:
                message = F.concat(F.lit(f"no label of {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))
                result = result.withColumn(_indexed(name), F.coalesce(index, F.raise_error(message).cast("double")))
            many = size + 1 if self.unseen == "keep" else max(1, size)
            nominal = {"type": "nominal", "name": _indexed(name), "num_vals": many}
            result = result.withMetadata(_indexed(name), {"ml_attr": nominal})
        return result

    def index(self, df: DataFrame, salt: int = SALT) -> DataFrame:
        """Adds ``<column>_indexed`` by the rule."""
        result = df
        if self.unseen == "skip":
            # One condition per column, so that each moves to the side of a join that has it.
            for name in self.columns:
                result = result.filter(F.col(name).isNotNull())
        return self.settle(self.attach(result, salt=salt))

    def transform(self, df: DataFrame, include_dense: bool = False, vectors: bool = True, salt: int = SALT) -> DataFrame:
        """Indexed, one-hot encoded and assembled, as :func:`encode_categoricals` does it."""
        return encode_indexed(self.index(df, salt), self.columns, include_dense, vectors)


ENCODER_COLUMNS = "position int, column string, labels bigint"


def fit_encoder(
    df: DataFrame, columns: Sequence[str], weight: Column | None = None, path: str | None = None, unseen: str = "skip"
) -> FittedEncoder:
    """Fits the labels of ``columns`` and keeps them under ``path``, a shared folder, by default a scratch one.

    ``weight`` is the number of rows that one row of ``df`` stands for.
    """
    spark = df.sparkSession
    path = (path or scratch_path(spark, "encoder")).rstrip("/")
    ranked = rank_labels(label_frequencies(df, columns, weight), path)
    ranked.write.partitionBy("position").parquet(f"{path}/ranks")
    names = spark.createDataFrame(list(enumerate(columns)), "position int, column string")
    sizes = _ranks(spark, path).groupBy("position").agg(F.count(F.lit(1)).alias("labels"))
    names.join(sizes, "position", "left").select("position", "column", F.coalesce("labels", F.lit(0)).alias("labels")).write.parquet(f"{path}/columns")
    return load_encoder(spark, path, unseen)


def _ranks(spark: SparkSession, path: str) -> DataFrame:
    """A folder for each position, so that a column's join reads its own labels only."""
    schema = "label string, n bigint, label_index double, position int"
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/ranks").select("position", "label", "n", "label_index")


def load_encoder(spark: SparkSession, path: str, unseen: str = "skip") -> FittedEncoder:
    """An encoder that :func:`fit_encoder` has kept under ``path``."""
    rows = spark.read.schema(ENCODER_COLUMNS).parquet(f"{path.rstrip('/')}/columns").orderBy("position").collect()
    return FittedEncoder([row["column"] for row in rows], _ranks(spark, path), [row["labels"] for row in rows], unseen)


def index_labels(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    weight: Column | None = None,
    salt: int = SALT,
    stage: str | None = None,
) -> DataFrame:
    """Adds ``<column>_indexed``; rows with a null in any of ``columns`` are dropped.

    ``fit_on`` (with ``weight``) is a smaller frame with the same label frequencies, when the caller has one.
    """
    return fit_encoder(df if fit_on is None else fit_on, columns, weight, stage).index(df, salt)


def feature_slots(df: DataFrame, columns: Sequence[str], output: str = "feature_slots") -> DataFrame:
    """Adds the slots of the ones in the assembled vector, as ``array<int>``, without building any vector.

    A column's slots come after those of the columns before it. The width of the whole is in the metadata of
    ``output`` (``num_attrs``). For columns with very many labels.
    """
    sizes = label_counts(df, columns)
    starts = [sum(sizes[:position]) for position in range(len(columns))]
    slots = F.array(*[(F.col(_indexed(name)) + start).cast("int") for name, start in zip(columns, starts)])
    return df.withColumn(output, slots).withMetadata(output, {"num_attrs": sum(sizes)})


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_indexed_encoded`` vectors with a slot for every label.

    The vector lengths come from the index columns' metadata where it is there, else from one aggregate.
    """
    encoder = OneHotEncoder(
        inputCols=[_indexed(name) for name in columns],
        outputCols=[_encoded(name) for name in columns],
        dropLast=False,
    )
    return encoder.fit(df).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "cat_features") -> DataFrame:
    """Concatenates the encoded vectors."""
    return VectorAssembler(inputCols=[_encoded(name) for name in columns], outputCol=output).transform(df)


def expand_vector(df: DataFrame, column: str = "cat_features", prefix: str = "cat_feature") -> DataFrame:
    """One double column per vector slot, named ``prefix[i]``.

    The number of slots is in the metadata of an assembled vector; for any other vector column it is that of its longest vector, from
    one aggregate. Shorter vectors and null ones have nulls in the slots they lack; an empty frame without metadata has no slots.
    """
    if not isinstance(df.schema[column].dataType, T.UserDefinedType):
        raise ValueError(f"{column} is no vector column and has no vector length")
    attributes = df.schema[column].metadata.get("ml_attr", {})
    values = F.when(F.col(column).isNotNull(), vector_to_array(F.col(column)))
    if "num_attrs" in attributes:
        width = attributes["num_attrs"]
    else:
        width = df.agg(F.max(F.array_size(values))).first()[0] or 0
    slots = df.withColumn("_slots", values)
    return slots.select(
        *[f"`{name}`" for name in df.columns],
        *[F.get("_slots", F.lit(i)).alias(f"{prefix}[{i}]") for i in range(width)],
    )


def vectors_as_text(df: DataFrame) -> DataFrame:
    """Every vector column as its text form, which names only the non-zero slots of a sparse vector."""
    return df.withColumns(
        {
            field.name: F.col(field.name).cast("string")
            for field in df.schema
            if isinstance(field.dataType, T.UserDefinedType)
        }
    )


def encode_indexed(df: DataFrame, columns: Sequence[str], include_dense: bool = False, vectors: bool = True) -> DataFrame:
    """Encodes and assembles indexed columns, row by row, so that an order of ``df`` stays.

    Without ``vectors`` there is one column of slot numbers instead of the vectors.
    """
    if not vectors:
        return feature_slots(df, columns)
    assembled = assemble(one_hot(df, columns), columns)
    return expand_vector(assembled) if include_dense else assembled


def encode_categoricals(
    df: DataFrame,
    columns: Sequence[str] = tuple(DEFAULT_COLUMNS),
    include_dense: bool = False,
    fit_on: DataFrame | None = None,
    weight: Column | None = None,
    salt: int = SALT,
    vectors: bool = True,
    stage: str | None = None,
) -> DataFrame:
    """Index, one-hot encode and assemble ``columns``; ``include_dense`` also expands the result."""
    return encode_indexed(index_labels(df, columns, fit_on, weight, salt, stage), columns, include_dense, vectors)
