"""Texts that the tests of this folder share, and fixtures made of them."""

import random

import pytest

#: Columns whose names the operators use inside.
CLASH = ("key string, at int, h string, fp string, node int, spans string, ids string, range int, "
         "block int, lang_pred string, score string, size string, windows int, n int")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["an", "be", "cor", "del", "est", "fo", "gra", "hin", "ion", "ju", "ké", "lo"]
    words = ["".join(r.choices(parts, k=r.randint(1, 4))) + r.choice(["", "", "", ",", "."])
             for _ in range(n)]
    return " ".join(w.capitalize() if r.random() < 0.1 else w for w in words)


def texts() -> list[tuple[int, str | None]]:
    passage, base = prose(1, 70), prose(2, 400)
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in (30, 200, 370)]
    long = prose(3, 9_000)
    rows = [(0, prose(10, 120) + " " + passage), (1, base), (2, base), (3, near[0]), (4, near[1]),
            (5, passage + "\n" + prose(11, 90)), (6, None), (7, ""), (8, "   \t\n"), (9, "One two."),
            (10, "A" * 70_000), (11, long), (12, prose(12, 30) + long[20_000:40_000]),
            (13, "12 34, 5.6 <|endoftext|> é ß 中文 \x1c  x \x00y"), (14, near[2]),
            (15, "to be " * 300), (16, prose(13, 60) + " " + "to be " * 40), (17, "one\ttwo\vthree"),
            (18, long.replace(" ", "")), (19, prose(14, 49)), (20, prose(14, 49) + " more")]
    return rows + [(i, prose(i, 40)) for i in range(21, 40)]


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The texts with columns of clashing names, in several partitions."""
    blank = (None,) * len(CLASH.split(","))
    return spark.createDataFrame([r + blank for r in rows],
                                 f"doc_id long, text string, {CLASH}").repartition(5).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("doc_id < 0")
