"""Small tables with the awkward cases every operator must take."""

import random

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, score double, row int, "
              "key string, n int, fp string, chunk int, begin int, n_lines int, begin_ string, batch string")


def docs(spark, rows):
    """Documents (id, text) with extra columns whose names the operators use themselves."""
    full = [(i, t, "en", "s", len(t or ""), "x", 0.5, 1, "k", 2, "f", 3, 4, 5, "b", None) for i, t in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def edge_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    rnd = random.Random(5)
    vocabulary = ["alpha", "beta", "gamma", "delta", "épée", "漢字", "x1", "don't", "A", "the", "of"]
    prose = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (3, 12, 40, 41, 200)]
    return [(1, prose[2]), (2, None), (3, ""), (4, " \t\n "), (5, prose[2]), (5, prose[2]), (6, prose[0]), (7, prose[1]),
            (8, prose[3] + "\n" + prose[2] + "\n\n" + prose[2]), (None, prose[4]), (None, None), (9, prose[4] + " tail"),
            (10, "a" * 300), (11, "a" * 120 + "b"), (12, " ".join(rnd.choice(vocabulary) for _ in range(30_000))),
            (13, "one\ntwo\r\n three lines here \nTHREE LINES HERE\n")]


def blank_rows():
    """Very long runs of white space, and the string of the vocabulary's added token."""
    return [(40, "a" + " " * 1_000_000 + "x"), (41, "\n" * 300_000 + " \t" * 100_000 + "end"), (42, " " * 50_000),
            (43, "x <|endoftext|> y<|endoftext|>"), (44, "<|endoftext|>" + " " * 3000 + "<|endoftext|>z"), (45, "é" * 40_000)]


def prose_rows(n=120, seed=1):
    """Documents with exact and near copies, shared passages and repeated lines."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage, line = text(60), text(6)
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and i:
            out.append((i, out[rnd.randrange(len(out))][1]))
        elif kind == 1 and i > 8:
            near = out[rnd.randrange(len(out))][1].split(" ")
            near[rnd.randrange(len(near))] = "changed"
            out.append((i, " ".join(near)))
        elif kind == 2:
            out.append((i, text(30) + " " + passage + " " + text(20)))
        elif kind == 3:
            out.append((i, text(20) + "\n  " + line.upper() + "\t\n" + text(20) + "\n" + line))
        else:
            out.append((i, text(rnd.randint(1, 150))))
    return out
