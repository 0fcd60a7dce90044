"""The command line runs both programs on files written from the fixture."""

import json

from treeclass.__main__ import main
from treeclass.plans.context import Context
from treeclass.session import scratch_path
from treeclass.sources import tsv


def test_cli_classify_and_flat_cost(spark, capsys):
    c = Context(spark, "/root/testdata/sf0.001")
    d = scratch_path(spark, "cli")
    tsv.write_ads(c.items.join(c.labels, "id"), f"{d}/train")
    tsv.write_test_ads(c.items, f"{d}/test")
    tsv.write_categories(c.category, f"{d}/cat")
    tsv.write_stopwords(c.stop, f"{d}/stop")
    c.lexicon.write.parquet(f"{d}/lex")
    common = ["--training", f"{d}/train", "--categories", f"{d}/cat", "--stopwords", f"{d}/stop",
              "--lexicon", f"{d}/lex", "--buckets", "1024"]
    main(["classify", *common, "--test", f"{d}/test", "--out", f"{d}/out", "--models", f"{d}/models"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == c.items.count()
    main(["flat-cost", *common])
    cost = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert cost["n"] > 0 and cost["mean_cost"] >= 0
