"""Counts and norms of vectors from what they store, not from an array of all buckets."""

import pytest
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import types as T

import __spark_entry__ as entry
from conftest import SF_SMALL
from treeclass.operators import features


def test_stored_values_of_sparse_dense_and_empty_vectors(spark):
    wide = 2**30  # an array of all buckets would take 8 GB
    rows = [(1, SparseVector(wide, [3, wide - 1], [0.0, 2.5])), (2, SparseVector(wide, [], [])), (3, DenseVector([1.0, 0.0])), (4, None)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT())])
    found = spark.createDataFrame(rows, schema).select("id", features.stored_values("features").alias("v")).collect()
    assert {r.id: r.v for r in found} == {1: [0.0, 2.5], 2: [], 3: [1.0, 0.0], 4: None}


def test_labeled_features_makes_no_dense_array(spark, monkeypatch):
    def dense(*_):
        pytest.fail("an array of all buckets for each item")
    monkeypatch.setattr("pyspark.ml.functions.vector_to_array", dense)
    rows = entry.queries()["labeled_features"](spark, SF_SMALL).collect()
    assert len(rows) > 0 and max(r.nnz for r in rows) > 0
    assert all((r.norm > 0) == (r.nnz > 0) for r in rows)
