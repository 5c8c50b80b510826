"""Small documents with the awkward cases every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use inside
                     T.StructField("hashes", T.StringType()), T.StructField("words", T.IntegerType()),
                     T.StructField("host", T.StringType()), T.StructField("lines", T.IntegerType()),
                     T.StructField("n_words", T.StringType()), T.StructField("node", T.LongType()),
                     T.StructField("cell", T.StringType()), T.StructField("c0", T.StringType()),
                     T.StructField("kept", T.BooleanType())])


def edge_texts() -> list[str | None]:
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma,", "delta.", "épsilon", "zeta", "eta", "theta;", "ñu", "日本", "x1", "y|z"]
    word = lambda: rng.choice(vocab) + rng.choice(["", "", "s", "e", "ing"])
    passage = " ".join(word() for _ in range(60))
    base = " ".join(word() for _ in range(150))
    long = " ".join(word() for _ in range(20_000))
    near = base.split(" ")
    near[70] = "changed"
    texts: list[str | None] = [None, "", " \t\n ", "one", "two words", base, base, " ".join(near), base.upper(), passage,
                               " ".join(word() for _ in range(40)) + "\n" + passage + "\n" + " ".join(word() for _ in range(30)),
                               passage + "\x0b" + passage, long, "spam " * 400, "###$$$ %%% " * 50,
                               "a\nb\na\nb\n\n" + passage[:80], "x y z\x1cw", "Ünïcode 日本語 テキスト " * 30]
    texts += [" ".join(word() for _ in range(rng.randint(5, 120))) for _ in range(25)]
    return texts


def edge_rows() -> list[tuple]:
    rows = []
    for i, t in enumerate(edge_texts()):
        lang, source = ["en", "de", None][i % 3], ["a", "b", None, "a"][i % 4]
        rows.append((i, t, lang, source, None if t is None else len(t), "h", i, "q", 7, "n", 1, "c", "0", False))
    rows.append(rows[5])                                   # a repeated row
    rows.append((5, "another text under an id in use " * 8, *rows[5][2:]))
    rows.append((None, rows[9][1], *rows[9][2:]))          # no id
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


def id_text(rows) -> list[tuple]:
    return [(r[0], r[1]) for r in rows]


def same(a, b) -> bool:
    return sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
