import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hits string, words string, d long, region string"


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows, texts = [], []
    for i in range(n):
        kind = i % 10
        if kind == 3 and texts:
            text = rng.choice(texts)
        elif kind in (4, 5) and texts:
            w = (rng.choice(texts) or "x").split(" ")
            w[rng.randrange(len(w))] = "edited" + str(i)
            text = " ".join(w)
        elif kind == 6:
            text = " ".join(rng.choice(vocabulary) for _ in range(30)) + "\n" + passage + "\n\t " + " ".join(rng.choice(vocabulary) for _ in range(30))
        elif kind == 7:
            text = "\n".join(["same line here"] * 3 + [" ".join(rng.choice(vocabulary) for _ in range(20))])
        else:
            text = "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40))) for _ in range(rng.randint(1, 6)))
        texts.append(text)
        rows.append((i * 3, text))
    rows += [(1, None), (2, ""), (4, "  \n\t "), (5, "one"), (7, "one two three"), (8, "#$ 12 !!"), (10, " ".join(vocabulary * 40)), (11, texts[0].upper())]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        lang = [None, "en", "de", "fr"][i % 4]
        out.append((doc_id, text, lang, [None, "a", "b"][min(i % 5, 2)], None, "x", "y", 3, "z"))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """Some rows twice, and one without a doc_id."""
    return spark.createDataFrame(rows + rows[:7] + [(None, rows[0][1], *rows[0][2:])], SCHEMA)
