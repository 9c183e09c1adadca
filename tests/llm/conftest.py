from __future__ import annotations

import random

import pytest

from tests.llm.helpers import ODD, SCHEMA


def _words(rng: random.Random, n: int) -> list[str]:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """Documents with exact and near copies, shared passages and lines, one hot text, a long one."""
    rng = random.Random(11)
    passage = " ".join(_words(rng, 60))
    lines = [" ".join(_words(rng, 8)) for _ in range(4)]
    hot = " ".join(_words(rng, 90))
    out = []
    for i in range(60):
        words = _words(rng, rng.randint(5, 160))
        if i % 6 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        text = " ".join(words)
        if i % 5 == 0:
            text = text + "\n" + "\n".join(lines) + "\n" + " ".join(_words(rng, 5))
        out.append(text)
    out += [hot] * 25
    for k in range(20):  # near copies of the hot text
        words = hot.split()
        for _ in range(k % 7):
            words[rng.randrange(len(words))] = _words(rng, 1)[0]
        out.append(" ".join(words))
    out += [out[3] + " tail", out[4].upper(), "\n\n" + out[5] + "\n"]
    out.append(" ".join(_words(rng, 6000)) + " " + passage)
    out.append("ab " * 700)
    return [(i, t, ["en", "de"][i % 2], f"s{i % 3}", len(t)) for i, t in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns with the names that operators use inside."""
    extra = {c: docs["doc_id"].cast("string") for c in ("id", "h", "n", "row", "text2", "gone", "lines", "rest", "spans", "kept", "anchor", "u", "v")}
    return docs.withColumns(extra)
