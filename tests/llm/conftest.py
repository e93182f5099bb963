import random

import pytest

EXTRA = "lang string, source string, score double, n bigint, `set` int, place string, shard string, slot int, rank string, matches string"
SCHEMA = "doc_id bigint, text string, " + EXTRA
CLASH = ("en", "s", 0.5, 7, 1, "here", "a", 3, "r", "m")


def words(seed: int, n: int) -> list[str]:
    """Invented words; equal seeds give equal words."""
    draw = random.Random(seed)
    return ["".join(draw.choice(["an", "ti", "re", "lo", "ou", "sh", "É", "k"]) for _ in range(draw.randint(1, 4))) for _ in range(n)]


def odd_texts() -> list[str | None]:
    return [None, "", " \n\t ", "one", "one", "One two three", "a b c d e f", "x\n\n\ny\r\nz", "é" * 900, "b\x00c " * 300, "$$$ %%% !!"]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): near and exact copies, repeated passages and lines, odd and long
    texts, null and repeated ids, rows that occur twice."""
    draw = random.Random(5)
    passage, line = " ".join(words(900, 60)), " ".join(words(901, 12))
    texts = odd_texts()
    for seed in range(30):
        own = words(seed, 80 + seed)
        texts.append("\n".join(" ".join(own[i : i + 9]) for i in range(0, len(own), 9)))
        if seed % 3 == 0:
            near = list(own)
            near[draw.randrange(len(near))] = "edited"
            texts.append(" ".join(near).replace(" ", "\n", 2))
        if seed % 4 == 0:
            texts.append(" ".join(own[:40]) + "\n" + passage + "\n" + line)
        if seed % 5 == 0:
            texts += [texts[-1]] * 3
    texts.append(" ".join(words(77, 30_000)))
    base = words(500, 90)
    for i in range(140):  # a dense group, each an edit or two from the base
        near = list(base)
        for _ in range(2):
            near[draw.randrange(len(near))] = f"edit{i}"
        texts.append(" ".join(near))
    out = list(enumerate(texts))
    return [*out, (None, "no id " * 90), (None, "no id " * 90), (3, "third again " * 70), out[20], out[20]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def both(found, wanted):
    """Rows as sorted lists, nulls and all."""
    return sorted(map(tuple, found), key=repr), sorted(map(tuple, wanted), key=repr)
