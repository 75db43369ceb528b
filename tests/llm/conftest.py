import random

import pytest

from raincheck.llm.common import ready

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "d string, th int, hits int, score string, n_words string, start string, piece int, pos double")


def words(rng, n, vocab=400):
    return " ".join("".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 7))) + str(rng.randrange(vocab) % 7)
                    for _ in range(n))


def messy_rows():
    """Nulls, blanks, very long texts, copies, near copies, shared passages, ties, repeated rows."""
    rng = random.Random(7)
    passage, other = words(rng, 60), words(rng, 45)
    base = words(rng, 120)
    near = base.split(" ")
    near[50] = "changed"
    lines = "\n".join(words(rng, 8) for _ in range(9))
    long = words(rng, 9000)
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, base), (6, base), (7, " ".join(near)),
        (8, words(rng, 30) + " " + passage + "\n" + words(rng, 20)),
        (9, words(rng, 3) + " " + passage + "  " + words(rng, 50)), (10, passage), (None, passage + " " + other),
        (11, long), (12, words(rng, 10) + "\n" + lines + "\nend"), (13, lines + "\n" + words(rng, 5)),
        (14, "same " * 200), (15, "x" + "same " * 90), (16, "a" * 700), (17, "ab" * 400 + "a" * 300),
        (18, other), (18, other), (18, words(rng, 25)), (19, long[:20000] + words(rng, 40)), (None, None),
        (20, "\n\n\n\n\n\n"), (21, "É" + other.upper()), (22, "🙂" * 150 + passage), (23, "🙂" * 150),
    ]
    return [(i, t, "en", "s", len(t or ""), "clash", 1, 2, "s", "w", "x", 3, 0.5) for i, t in texts]


@pytest.fixture(scope="session")
def llm_spark(spark):
    ready(spark)
    return spark


@pytest.fixture(scope="session")
def messy(llm_spark):
    return llm_spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pairs():
    return [(r[0], r[1]) for r in messy_rows()]
