"""Command line: the two end-to-end programs.

    python -m treeclass classify --training 'data/training.*.tsv' --test 'data/test.*.tsv' \\
        --categories data/categories.tsv --stopwords data/stop_words.txt \\
        --lexicon lexicon.parquet --out results/predictions --models model/hierarchy \\
        [--metrics results/metrics] [--buckets 30720] [--emit-level1] [--lower] \\
        [--idf fit_once|per_node|refit] [--tf-only]

    python -m treeclass flat-cost --training 'data/training.*.tsv' \\
        --categories data/categories.tsv --stopwords data/stop_words.txt \\
        --lexicon lexicon.parquet [--buckets 102400] [--lower]

The lexicon is a parquet table ``orth, ordinal, tag_id, lemma``.  The session
comes from ``spark-submit`` / the cluster defaults (``getOrCreate``).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from treeclass.operators.features import CASCADE_BUCKETS, FLAT_BUCKETS_BY_LEVEL
from treeclass.plans import flows


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="treeclass")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("classify")
    f = sub.add_parser("flat-cost")
    for p in (c, f):
        p.add_argument("--training", required=True)
        p.add_argument("--categories", required=True)
        p.add_argument("--stopwords", required=True)
        p.add_argument("--lexicon", required=True)
        p.add_argument("--lower", action="store_true", help="fold the case of titles first")
    c.add_argument("--test", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--models", required=True)
    c.add_argument("--metrics")
    c.add_argument("--buckets", type=int, default=CASCADE_BUCKETS)
    c.add_argument("--emit-level1", action="store_true")
    c.add_argument("--idf", choices=flows.IDF_MODES, default="fit_once")
    c.add_argument("--tf-only", action="store_true")
    f.add_argument("--buckets", type=int, default=FLAT_BUCKETS_BY_LEVEL[1])
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("treeclass").getOrCreate()
    lexicon = spark.read.parquet(args.lexicon)
    if args.cmd == "classify":
        out = flows.classify(spark, args.training, args.test, args.categories, args.stopwords,
                             lexicon, args.out, args.models, args.metrics, args.buckets,
                             emit_level1=args.emit_level1, lower=args.lower, idf=args.idf,
                             use_idf=not args.tf_only)
        print(json.dumps({"predictions": args.out, "rows": out.count()}))
    else:
        r = flows.flat_cost(spark, args.training, args.categories, args.stopwords, lexicon,
                            num_buckets=args.buckets, lower=args.lower).first()
        print(json.dumps({"n": r["n"], "total_cost": r["total_cost"], "mean_cost": r["mean_cost"]}))


if __name__ == "__main__":
    main()
