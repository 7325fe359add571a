import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(seed: int = 5, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, blanks, ties and one very long text."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)] + ["Ünïcode", "the", "The", "x y", "#tag", "***"]
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        if i % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split(" ")
        text = " ".join(words).replace("the", "the\n").replace("w7", "w7\t")
        if i % 7 == 3 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 11 == 4 and rows:
            near = (rows[rng.randrange(len(rows))][1] or "").split(" ")
            near[rng.randrange(len(near))] = "changed"
            text = " ".join(near)
        rows.append((i * 3 + 1, text, "en", "src0" if i % 3 else f"src{i % 4}", None))
    rows += [(500, None, None, None, None), (501, "", "en", "src1", 0), (502, " \t\n", "en", "src1", 3), (503, "one", "en", "src1", 3), (503, "one", "en", "src1", 3), (None, "null id " * 30, "en", "src2", 3), (504, "long run of words " * 4000, "de", "src0", 5)]
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
