import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text[, lang[, source]]) tuples."""
    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or ""),
                 *r[4:]) for r in rows]
        return spark.createDataFrame(full, DOC + extra).repartition(3)
    return make


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def odd_rows():
    """Nulls, empty and white texts, case, copies, near copies, a long text and a shared passage."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 70)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "a b c"), (7, base), (8, base),
            (9, base.upper()), (10, base + " tail"), (11, base.replace("w7 ", "x7 ")), (12, prose(rng, 60) + " " + passage),
            (13, passage + " " + prose(rng, 80)), (14, prose(rng, 4000)), (15, "été à la plage"), (16, "a b c"),
            (17, passage), (18, None), (19, "  nbsp em"), (20, "😀 b\x0bc\x0cd 12")]
    rows += [(100 + k, prose(rng, rng.randrange(1, 90))) for k in range(30)]
    text = prose(rng, 200).split()
    for k in range(40):  # a crowd of near copies at many similarities
        t = list(text)
        for _ in range(rng.randrange(0, 12)):
            t[rng.randrange(200)] = f"edit{rng.randrange(10**6)}"
        rows.append((200 + k, " ".join(t)))
    return rows
