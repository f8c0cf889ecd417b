import random

import pytest

WORDS = [a + b + c for a in ("ta", "ro", "mi", "ke", "zu", "lo") for b in ("n", "rs", "l", "mp") for c in ("a", "or", "ish", "um")]


def prose(seed: int, n: int, line: int = 12) -> str:
    r = random.Random(seed)
    return "\n".join(" ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(min(line, n - i))) for i in range(0, n, line))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(w if r.random() > share else "edit" + str(r.randrange(999)) for w in text.split(" "))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, _spans string"


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, copies, repeated rows, odd blanks."""
    base = [prose(i, 80) for i in range(12)]
    texts = {0: None, 1: "", 2: "a b", 3: prose(99, 30_000), 4: base[0], 5: base[0], 6: edited(base[0], 1, 0.02), 7: base[1].upper(), 8: base[1], 9: "A\tb\n\n c  d \x0b e\x1cf 東京 é ́x", 10: " \n ", 11: "tanor tanor tanor " * 30}
    texts |= {20 + i: t for i, t in enumerate(base)}
    texts |= {40 + i: edited(base[2], i, 0.03) for i in range(6)}
    out = [(i, t, "en", "s", len(t or ""), 1, "x") for i, t in texts.items()]
    return [*out, out[5], (None, base[3], None, None, None, None, None)]


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
