"""The features of the three levels on one row."""

import re

import __spark_entry__ as entry
from conftest import SF_SMALL
from treeclass.operators import features


def test_join_levels_keeps_each_label_row_once(spark):
    labels = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (2, 0), (3, 0), (None, 0)], "id long, l1_idx int")

    def level(n, rows):
        return features.level_features(spark.createDataFrame(rows, "id long, bucket int, value double"), n)
    levels = [level(1, [(1, 5, 0.5), (1, 2, 0.25), (2, 1, 1.0), (None, 1, 1.0)]),
              level(2, [(1, 7, 0.0), (2, 1, 2.0), (3, 1, 1.0), (None, 1, 1.0)]),
              level(3, [(1, 9, 3.0), (3, 1, 1.0), (None, 1, 1.0)])]
    got = [(r.id, r.l1_idx, *([tuple(x) for x in r[f"features{n}"]] for n in (1, 2, 3)))
           for r in features.join_levels(labels, levels).collect()]
    own = ([(2, 0.25), (5, 0.5)], [(7, 0.0)], [(9, 3.0)])
    assert sorted(got) == [(1, 0, *own), (1, 0, *own), (1, 1, *own)]  # items 2 and 3 lack a level


def test_features_of_each_level_are_built_and_joined(spark, monkeypatch):
    equal = {r.id: r for r in entry.queries()["features_join"](spark, SF_SMALL).collect()}
    monkeypatch.setattr(features, "CASCADE_BUCKETS_BY_LEVEL", {1: 3, 2: 11, 3: features.CASCADE_BUCKETS})
    df = entry.queries()["features_join"](spark, SF_SMALL)
    most = {}
    for r in df.collect():
        level = 3 if r.l3_idx >= 0 else 2 if r.l2_idx >= 0 else 1
        most[level] = max(most.get(level, 0), r.n_terms)
        assert level < 3 or (r.n_terms, r.tfidf_sum) == (equal[r.id].n_terms, equal[r.id].tfidf_sum)
    assert most[1] <= 3 and most[2] <= 11 < most[3]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Inner, \(id", plan)) == 3  # two of the levels' chain, one with the labels
