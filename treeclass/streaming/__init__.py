from treeclass.streaming.score_stream import classify_stream  # noqa: F401
