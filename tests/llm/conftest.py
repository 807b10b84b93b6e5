import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # names that operators use inside
        "h1 long, h2 long, row string, id long, txt string, rid long, n long, words string, kept string, th long, "
        "fp long, ids string, score double, spans string, label int, t string")
EXTRA = (1, 2, "r", 3, "x", 4, 5, "w", "k", 6, 7, "i", 0.5, "s", 1, "t")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ou"]
    words = ["".join(random.Random(i).choices(parts, k=1 + i % 4)) for i in range(vocabulary)]
    out = []
    for i in range(n):
        out.append(rnd.choice(words))
        if i % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out)


def edge_rows():
    long = prose(1, 9000)
    good = [prose(s, 120) for s in range(10, 16)]
    texts = [
        (1, good[0]), (2, good[0]), (3, good[1]), (4, None), (5, ""), (6, " \t\n\n "), (7, long), (8, long),
        (None, good[0]), (None, good[2]), (10, good[2]), (11, good[3]), (11, good[3]), (12, "one"), (13, "ONE"),
        (14, "the same line here\n" * 5), (15, "x\nThe Same Line here \n\ny"), (16, good[4] + "\n" + good[5]),
        (17, "w " * 400), (18, "@@@ ### $$$ %%% " * 30), (19, "naïve ▁ blank　wide \U0001F600 " + good[4]),
    ]
    rows = []
    for i, (d, t) in enumerate(texts):
        rows.append((d, t, None if i % 7 == 3 else "en", None if i % 5 == 4 else f"s{i % 3}",
                     None if i % 6 == 5 else len(t or ""), *EXTRA))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows(), DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (3, 1, 0), (11, 1, 0), (11, 1, 0), (16, 1, 1), (18, 0, 0), (17, 0, 1), (None, 1, None),
            (99, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def edge_items(spark):
    words = prose(12, 120).split()
    rows = [(0, " ".join(words[20:60])), (1, " ".join(words[20:60])), (2, None), (3, ""), (4, "one"),
            (5, " ".join(words[70:75])), (None, " ".join(words[80:110]))]
    return spark.createDataFrame(rows, "item_id long, text string")
