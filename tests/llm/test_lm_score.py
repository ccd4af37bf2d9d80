import math
import random
from collections import Counter

import pytest

from panelkit.llm.lm_score import count_words, score_texts, score_words
from tests.llm.brute import words
from tests.llm.conftest import prose


def plain(rows, backoff=0.4, least=2):
    grams = [Counter() for _ in range(5)]
    for _, t in rows:
        z = "\0\0\0" + (t or "")
        for i in range(3, len(z)):
            for n in range(1, 5):
                grams[n][z[i - n + 1:i + 1]] += 1
    contexts = [Counter() for _ in range(5)]
    for n in range(2, 5):
        for g, c in grams[n].items():
            contexts[n][g[:-1]] += c
    total = sum(grams[1].values())

    def score(g):
        n = len(g)
        if n == 1:
            return grams[1][g] / total
        if grams[n][g] >= least:
            return grams[n][g] / contexts[n][g[:-1]]
        return backoff * score(g[1:])

    out = []
    for i, t in rows:
        z = "\0\0\0" + (t or "")
        out.append((i, len(z) - 3, sum(math.log(score(z[k - 3:k + 1])) for k in range(3, len(z)))))
    return out


@pytest.mark.parametrize("limit", [10**6, 0])
def test_scores_match_plain_counting(documents, odd_rows, limit):
    rows = odd_rows[:13] + odd_rows[14:40] + [(7, "twice"), (7, "twice"), (None, "no id é")]
    got = score_texts(documents(rows), broadcast_rows=limit).collect()
    a = sorted((str(r.doc_id), r.n_units, round(r.log_score, 6)) for r in got)
    b = sorted((str(i), n, round(s, 6)) for i, n, s in plain(rows))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert all(x[2] == pytest.approx(y[2], abs=1e-5) for x, y in zip(a, b))
    assert all(r.mean_score is None for r in got if r.n_units == 0)


def test_foreign_text_scores_lower_and_empty_table(documents):
    rng = random.Random(1)
    rows = [(k, prose(rng, 50, 20)) for k in range(40)] + [(99, "zqxj kvbp qqzx jjkv")]
    got = {r.doc_id: r.mean_score for r in score_texts(documents(rows)).collect()}
    assert min(got, key=got.get) == 99
    assert score_texts(documents([])).count() == 0
    clash = documents([(1, "a", "en", "s", 3, 4)], ", g long, n long")
    assert score_texts(clash).first().n_units == 1


def plain_words(rows, order, backoff=0.4, least=2):
    grams, contexts = Counter(), Counter()
    for _, t in rows:
        z = ["\0"] * (order - 1) + words(t)
        for i in range(order - 1, len(z)):
            for n in range(1, order + 1):
                grams[tuple(z[i - n + 1:i + 1])] += 1
                contexts[n, tuple(z[i - n + 1:i])] += 1

    def score(g):
        if len(g) == 1 or grams[g] >= least:
            return grams[g] / contexts[len(g), g[:-1]]
        return backoff * score(g[1:])

    out = []
    for i, t in rows:
        z = ["\0"] * (order - 1) + words(t)
        out.append((i, len(words(t)), sum(math.log(score(tuple(z[k - order + 1:k + 1]))) for k in range(order - 1, len(z)))))
    return out


@pytest.mark.parametrize("order,limit,least", [(1, 0, 2), (2, 10**6, 2), (2, 0, 2), (2, 0, 1), (3, 10**6, 3), (3, 0, 2)])
def test_word_scores_match_plain_counting(documents, odd_rows, order, limit, least):
    rows = odd_rows[:13] + odd_rows[14:40] + [(7, "twice"), (7, "twice"), (None, "no id é")]
    got = score_words(documents(rows), order=order, broadcast_rows=limit, min_count=least).collect()
    a = sorted((str(r.doc_id), r.n_units, round(r.log_score, 6)) for r in got)
    b = sorted((str(i), n, round(s, 6)) for i, n, s in plain_words(rows, order, least=least))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert all(x[2] == pytest.approx(y[2], abs=1e-5) for x, y in zip(a, b))
    assert all(r.mean_score is None for r in got if r.n_units == 0)


def test_word_table_grows_with_the_corpus_and_empty_table(documents):
    rng = random.Random(2)
    rows = [(k, prose(rng, 60, 300)) for k in range(160)]
    few, many = (count_words(documents(r), [1, 0]).count() for r in (rows[:20], rows))
    assert many > 4 * few
    assert score_words(documents([])).count() == 0
    clash = documents([(1, "a b", "en", "s", 3, 4)], ", g long, n long")
    assert score_words(clash).first().n_units == 2
