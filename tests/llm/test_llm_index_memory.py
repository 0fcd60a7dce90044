"""What tasks hold at once: row groups of the positional index, words of the benchmark, ids of a text."""

import os
import pickle

import pyarrow.parquet as pq
from fixtures import docs

from treeclass.llm import decontaminate, tokens


def test_index_of_many_shards_is_written_in_small_row_groups(spark):
    def text():
        letters = os.urandom(190_000).hex()
        return " ".join(letters[i:i + 6] for i in range(0, len(letters), 6))
    rows = [(i, text()) for i in range(40)]
    index = decontaminate.build_index(docs(spark, rows).coalesce(1), shard_bytes=100_000)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert index.count() == 40 and sum(g.num_rows for g in groups) == 40
    assert sum(g.total_byte_size for g in groups) > 30 << 20
    assert max(g.total_byte_size for g in groups) < 25 << 20  # no page of 100 rows


def test_windows_cost_some_bytes_a_word():
    text = " ".join(f"w{i % 5000}" for i in range(100_000))
    windows = decontaminate.Windows([("1", text), ("2", "one two"), ("3", "w1 w2 w3"), ("4", "three one")], 13)
    assert len(pickle.dumps(windows)) < 20 * 100_000


def test_windows_in_parts_are_all_windows(monkeypatch):
    items = [("a", "a b c d e"), ("b", "x y"), ("a", "c d"), ("c", "b c d"), ("b", "q r s t"), ("d", "")]
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", 2)
    windows = decontaminate.Windows(items, 3)
    code = {w: int((windows.vocabulary == decontaminate.words(w.encode())[1][0]).argmax()) for w in "abcdexyqrst"}
    got = [(n, tuple(r), windows.names[i]) for n, rows, found in windows.parts() for r, i in zip(rows.tolist(), found)]
    want = [(min(3, len(w)), tuple(code[x] for x in w[k:k + min(3, len(w))]), item)
            for item, text in items for w in [text.split()] if w for k in range(len(w) - min(3, len(w)) + 1)]
    assert sorted(got) == sorted(want)
    assert all(len(rows) <= 2 for _, rows, _ in windows.parts())


def test_texts_are_encoded_one_at_a_time():
    seen = []

    class Encoder:
        def encode(self, text, allowed_special):
            seen.append(text)
            return [len(text)]
    ids = tokens.all_ids(Encoder(), ["a", "bb", "ccc"])
    assert next(iter(ids)) == [1] and seen == ["a"]
    assert list(ids) == [[2], [3]]
