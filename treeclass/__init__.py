"""treeclass — hierarchical short-text classification as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – readers/writers for item TSVs, taxonomy, stop words, lexicon,
                  predictions, metrics and models; plus the driver-table fixture.
* ``functions`` – column expressions (tokenizer, hashing, tag predicate, sigmoid).
* ``operators`` – DataFrame-in / DataFrame-out operators (taxonomy, encoding,
                  text, features, scoring, training, evaluation).
* ``plans``     – end-to-end flows and the registry of named queries.
* ``streaming`` – the scoring cascade applied to a Structured Streaming source.
"""

__version__ = "0.1.0"
