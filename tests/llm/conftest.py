from __future__ import annotations

import random

import pytest

from recoflow.llm.common import ship

#: Extra columns with the names of the operators' own working columns.
EXTRA = "_id long, _th long, n long, low string, node string, kept string, runs int, n_words int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, repeated rows, copies, near copies, shared passages and lines."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, lines = prose(60), "\n".join(prose(6) for _ in range(5))
    rows: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "one two"), (None, prose(30))]
    rows += [(10 + i, prose(rng.randint(1, 120)) + ("\n" + prose(20)) * (i % 3)) for i in range(12)]
    rows += [(30 + i, f"{prose(15)} {passage} {prose(10)}") for i in range(4)]
    rows += [(40 + i, f"{prose(8)}\n{lines}\n\n{prose(8)}") for i in range(4)]
    base = prose(100).split()
    for i in range(6):
        near = list(base)
        near[10 * i] = word() + "x"
        rows.append((50 + i, " ".join(near)))
    rows += [(60, rows[8][1]), (61, rows[8][1]), (61, rows[8][1]), (62, "spam " * 60), (63, prose(6000)), (64, "é日本 " * 15 + "😀")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", "y", "z", 4, 5) for i, t in rows], "doc_id long, text string, " + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")
