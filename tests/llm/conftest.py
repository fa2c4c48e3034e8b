import random

import pytest
from samples import prose

@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars): prose, copies, near copies, junk, odd values."""
    rng = random.Random(3)
    texts: list[tuple] = []
    base = [prose(rng, rng.choice([30, 60, 120, 400])) for _ in range(60)]
    base[3] = prose(rng, 400)
    texts += [(i, t, f"s{i % 5}") for i, t in enumerate(base)]
    for i in range(12):  # near copies of one text, some of them two edits away from each other
        w = base[3].split()
        for _ in range(1 + i % 3):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append((100 + i, " ".join(w), "s0"))
    texts += [(200 + i, base[7].upper(), "s1") for i in range(5)]
    texts += [(300, None, "s2"), (301, "", "s2"), (302, " \n\t ", None), (303, "one", "s3"), (304, "one two", "s3"), (305, "ONE two", None)]
    texts += [(306, "\n".join(["the same line here"] * 30), "s4"), (307, "é ü ñ Ä " * 10, "s4"), (308, prose(rng, 4000), "hot")]
    texts += [(309, "\x00 odd   signs ퟿ \U0001f600 " + prose(rng, 30), "s4")]
    texts += [(400 + i, prose(rng, 40), "hot") for i in range(40)]
    texts += [(5, base[5], "s0"), (None, base[9], None), (None, None, "s1")]  # a repeated row, rows without an id
    return [(i, t, "en", s, len(t or "")) for i, t, s in texts]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).cache()


@pytest.fixture(scope="session")
def odd_docs(docs):
    """The same with extra columns that are named like results and helpers."""
    from pyspark.sql import functions as F

    names = ("size", "key", "node", "label", "kept", "n_words", "recipe", "block", "u", "found", "score", "piece", "shard", "norm", "chunks", "copies")
    return docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
