from treeclass.sources.tsv import (  # noqa: F401
    ADS_SCHEMA, read_ads, read_categories, read_stopwords, read_test_ads,
    write_ads, write_categories, write_metrics, write_predictions, write_stopwords,
    write_test_ads, read_predictions, read_metrics,
)
