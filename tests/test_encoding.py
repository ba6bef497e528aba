from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from seatgrid.operators.encoding import (
    encode_categoricals,
    encode_indexed,
    expand_vector,
    fit_encoder,
    index_labels,
    label_frequencies,
    load_encoder,
    rank_labels,
)
from seatgrid.operators.ordering import order_listings

ROWS = [("b", 5), ("a", 5), ("a", None), ("b", 7), ("c", 7), (None, 7)]


def labels(df, column, indexed):
    """Labels in the order of their indexes, which the metadata counts."""
    pairs = sorted({(row[1], str(row[0])) for row in df.select(column, indexed).collect()})
    assert df.schema[indexed].metadata["ml_attr"] == {"type": "nominal", "name": indexed, "num_vals": len(pairs)}
    return [label for _, label in pairs]


def test_later_columns_are_ranked_on_the_rows_earlier_ones_keep(spark):
    df = spark.createDataFrame(ROWS, "c string, n int")
    encoded = encode_categoricals(df, ["c", "n"])
    assert labels(encoded, "c", "c_indexed") == ["a", "b", "c"]
    assert labels(encoded, "n", "n_indexed") == ["5", "7"]
    assert encoded.count() == 4
    [row] = encoded.filter("c = 'b' AND n = 5").collect()
    assert row.cat_features.toArray().tolist() == [0, 1, 0, 1, 0]
    assert labels(index_labels(df, ["n"]), "n", "n_indexed") == ["7", "5"]


def random_frame(spark, seed=3):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice(["x", "yy", "z", None]), rng.choice([*range(30), None]), rng.choice(["p", "q", None]))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "i int, a string, b int, c string")


def by_pipeline(df, columns):
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_indexed", handleInvalid="skip") for c in columns]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns], outputCols=[f"{c}_indexed_encoded" for c in columns],
        dropLast=False,
    )
    assembler = VectorAssembler(inputCols=[f"{c}_indexed_encoded" for c in columns], outputCol="cat_features")
    return Pipeline(stages=[*indexers, encoder, assembler]).fit(df).transform(df)


@pytest.mark.parametrize("salt", [1, 3])
def test_equals_a_pipeline_of_indexers(spark, salt):
    df, columns = random_frame(spark), ["a", "b", "c"]
    got = encode_categoricals(df, columns, salt=salt)
    want = by_pipeline(df, columns)
    assert got.columns == want.columns

    def values(frame):
        return sorted(
            (row.i, row.a_indexed, row.b_indexed, row.c_indexed, tuple(row.cat_features.toArray()))
            for row in frame.collect()
        )

    assert values(got) == values(want)


def test_indexes_carry_their_label_count(spark):
    encoded = encode_categoricals(random_frame(spark), ["a", "b"])
    assert encoded.schema["a_indexed_encoded"].metadata["ml_attr"]["num_attrs"] == 3
    assert encoded.schema["cat_features"].metadata["ml_attr"]["num_attrs"] == 33


def test_slot_numbers_equal_the_vectors(spark):
    df = random_frame(spark)
    slots = encode_categoricals(df, ["a", "b", "c"], vectors=False)
    assert slots.schema["feature_slots"].metadata == {"num_attrs": 35}
    got = {row.i: row.feature_slots for row in slots.collect()}
    vectors = encode_categoricals(df, ["a", "b", "c"]).collect()
    assert got == {row.i: [int(i) for i in row.cat_features.toArray().nonzero()[0]] for row in vectors}


def test_order_outlives_the_encoding_of_many_labels(spark):
    """Labels are joined without broadcasts; the sort comes after the joins, and the encoding adds no shuffle."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    df = spark.range(20_000).selectExpr(
        "id % 501 AS eventId", "(id * 7919) % 15013 AS sectionId", "cast(id % 97 AS double) AS Time_to_event"
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for vectors in (True, False):
            ordered = order_listings(index_labels(df, ["sectionId", "eventId"]))
            rows = encode_indexed(ordered, ["sectionId", "eventId"], vectors=vectors).select("eventId", "sectionId", "Time_to_event").collect()
            keys = [tuple(-value for value in row) for row in rows]
            assert len(rows) == 20_000 and keys == sorted(keys)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_weighted_fit_equals_fit_on_the_rows(spark):
    df = random_frame(spark).select("a", "b", "c")
    doubled = df.union(df.filter("a = 'z'")).union(df.filter("b < 4"))
    weighted = doubled.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("w"))
    key = ["position", "label"]
    plain = label_frequencies(doubled, ["a", "b", "c"]).orderBy(*key).collect()
    assert label_frequencies(weighted, ["a", "b", "c"], F.col("w")).orderBy(*key).collect() == plain


def test_distributed_ranks(spark):
    rng = random.Random(9)
    counts = [(p, f"l{i}", rng.randrange(1, 40)) for p in (0, 1, 3) for i in range(rng.randrange(200, 700))]
    df = spark.createDataFrame(counts, "position int, label string, n bigint").repartition(5)
    got = {(row.position, row.label): row.label_index for row in rank_labels(df).collect()}
    want = {}
    for position in (0, 1, 3):
        ordered = sorted((-n, label) for p, label, n in counts if p == position)
        want.update({(position, label): float(i) for i, (_, label) in enumerate(ordered)})
    assert got == want


def test_a_column_of_nulls_leaves_no_row(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "c string, n int")
    assert index_labels(df, ["c", "n"]).count() == 0
    assert index_labels(df.limit(0), ["c"]).count() == 0


def test_expand_vector(spark):
    df = spark.createDataFrame(ROWS, "c string, n int")
    dense = encode_categoricals(df, ["c", "n"], include_dense=True)
    names = [f"cat_feature[{i}]" for i in range(5)]
    assert dense.columns[-5:] == names
    for row in dense.collect():
        assert [row[name] for name in names] == row.cat_features.toArray().tolist()
    with pytest.raises(ValueError, match="no vector length"):
        expand_vector(df, "c")


def test_vectors_without_metadata_are_measured(spark):
    rows = [(1, Vectors.sparse(4, [3], [2.0])), (2, Vectors.dense([1.0, 5.0])), (3, None)]
    df = spark.createDataFrame(rows, ["i", "v"])
    dense = expand_vector(df, "v", "slot").drop("v")
    assert dense.columns == ["i", "slot[0]", "slot[1]", "slot[2]", "slot[3]"]
    assert sorted(map(tuple, dense.collect())) == [(1, 0.0, 0.0, 0.0, 2.0), (2, 1.0, 5.0, None, None), (3, None, None, None, None)]
    assert expand_vector(df.limit(0), "v").columns == ["i", "v"]


def test_a_kept_encoder_gives_later_rows_the_same_slots(spark, tmp_path):
    early = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3)], "c string, n int")
    path = str(tmp_path / "encoder")
    fit_encoder(early, ["c", "n"], path=path)
    later = spark.createDataFrame([(1, "b", 2), (2, "z", 2), (3, None, 1), (4, "a", 9), (5, "b", 1)], "i int, c string, n int")

    def encoded(unseen, **options):
        return load_encoder(spark, path, unseen).transform(later, **options)

    skipped = encoded("skip")
    got = {row.i: (row.c_indexed, row.n_indexed, row.cat_features.toArray().tolist()) for row in skipped.collect()}
    assert got == {1: (1.0, 0.0, [0, 1, 1, 0]), 5: (1.0, 1.0, [0, 1, 0, 1])}
    kept = encoded("keep")
    got = {row.i: row.cat_features.toArray().tolist() for row in kept.collect()}
    assert got == {
        1: [0, 1, 0, 1, 0, 0], 2: [0, 0, 1, 1, 0, 0], 3: [0, 0, 1, 0, 1, 0], 4: [1, 0, 0, 0, 0, 1], 5: [0, 1, 0, 0, 1, 0],
    }
    assert kept.schema["c_indexed"].metadata["ml_attr"]["num_vals"] == 3
    assert encoded("keep", vectors=False).schema["feature_slots"].metadata == {"num_attrs": 6}
    with pytest.raises(Exception, match="no label of c: z|no label of c: null"):
        encoded("error").collect()
    assert load_encoder(spark, path, "error").index(later.filter("i in (1, 5)")).count() == 2
    with pytest.raises(ValueError, match="unseen is one of"):
        encoded("drop")


def test_an_encoder_of_nothing_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "encoder")
    encoder = fit_encoder(spark.createDataFrame([], "c string, n int"), ["c", "n"], path=path, unseen="keep")
    assert encoder.columns == ["c", "n"] and encoder.sizes == [0, 0]
    [row] = load_encoder(spark, path, "keep").index(spark.createDataFrame([("a", 1)], "c string, n int")).collect()
    assert (row.c_indexed, row.n_indexed) == (0.0, 0.0)
    assert load_encoder(spark, path).index(spark.createDataFrame([("a", 1)], "c string, n int")).count() == 0


def test_indexes_may_be_attached_before_a_join(spark):
    df = random_frame(spark)
    encoder = fit_encoder(df, ["a", "b", "c"])
    sides = encoder.attach(df.select("a").distinct(), ["a"]).withColumnRenamed("a", "_a")
    joined = df.join(sides, F.col("a").eqNullSafe(F.col("_a"))).drop("_a")
    late = encoder.settle(encoder.attach(joined, ["b", "c"]))
    names = ["i", "a_indexed", "b_indexed", "c_indexed"]
    assert sorted(late.select(names).collect()) == sorted(encoder.index(df).select(names).collect())
