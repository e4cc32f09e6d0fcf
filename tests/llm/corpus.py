"""A small corpus with copies, near copies, shared passages, odd rows and extra columns."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, score string, `key_1` int"
BLANK = "[^\x20\x09-\x0d]+"
_UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text, lower=False):
    return re.findall(BLANK, (text or "").translate(_UPPER) if lower else text or "")


def _prose(rng, n):
    vocabulary = ["".join(rng.choice("abdeiknorstué") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    out = []
    for i in range(n):
        out.append(rng.choice(vocabulary))
        if rng.random() < 0.08:
            out[-1] += ".\n" if rng.random() < 0.5 else "."
    return " ".join(out)


def rows(seed=5, n=60):
    rng = random.Random(seed)
    texts = [_prose(rng, rng.choice([3, 12, 40, 120, 300])) for _ in range(n)]
    shared = _prose(rng, 45)
    for i in range(0, n, 7):
        texts[i] += " " + shared
    for i in range(0, n, 5):
        texts.append(texts[i])
    for i in range(1, n, 4):
        own = texts[i].split(" ")
        for _ in range(max(1, len(own) // 30)):
            own[rng.randrange(len(own))] = rng.choice(["x", "Y", "zz"])
        texts.append(" ".join(own))
    texts += ["", None, "  \n\t ", "one", "one two", "One TWO", "a " * 400, "long " + "q" * 5000, shared, shared + " " + shared]
    texts.append("\n".join(_prose(rng, 25) for _ in range(400)))
    out = [(i, t, "en", f"src{i % 3}" if i % 11 else None, len(t or ""), i % 2, "s", None) for i, t in enumerate(texts)]
    return out


def odd_rows():
    """Repeated rows, a repeated id with another text, and missing ids."""
    text = " ".join(f"w{i}" for i in range(60))
    return [
        (1, text, "en", "a", 1, 0, None, 1),
        (1, text, "en", "a", 1, 0, None, 1),
        (2, "other words " * 30, None, None, None, None, None, None),
        (2, text + " end", "en", "b", 1, 0, "x", 1),
        (None, text, "en", "b", 1, 0, "x", 1),
        (None, None, None, None, None, None, None, None),
        (7, None, None, "b", None, None, None, None),
    ]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)
