import random

import pytest

WORDS = [f"w{i}" for i in range(40)] + ["Étude", "naïve", "ça", "日本", "x" * 70]


@pytest.fixture(scope="session")
def texts():
    """Invented texts with copies, near copies and shared passages; also nulls and odd white space."""
    pick = random.Random(5)

    def some(n):
        return [pick.choice(WORDS) for _ in range(n)]

    base = [some(pick.randint(1, 120)) for _ in range(60)]
    out = [" ".join(one) for one in base]
    for one in base[:25]:
        near = list(one)
        near[pick.randrange(len(near))] = "edited"
        out += [" ".join(near), " ".join(one)]
    passage = some(30)
    for i in range(0, 60, 4):
        out.append(" ".join(base[i][:20] + passage[pick.randint(0, 10) :] + base[i + 1][:20]))
    out.append("\n\t ".join(base[0]).upper())
    out += ["", "  \t", None, None, "one", "one", "a b c", "A B C", " ".join(some(9000)), "  a b"]
    return list(enumerate(out))


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names operators use inside, one text twice under one id."""
    rows = [(i, text, i % 3, "salt", True) for i, text in texts]
    kind = "doc_id long, text string, bucket int, `salt of the join` string, kept boolean"
    return spark.createDataFrame([*rows, rows[3]], kind).repartition(5)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def null_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, "a b c d e f"), (None, "only here")]
    return spark.createDataFrame(rows, "doc_id long, text string")
