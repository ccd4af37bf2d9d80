import random

from panelkit.llm.mixing import mix_sources, mixed_rows
from tests.llm.brute import targets, words
from tests.llm.conftest import prose


def rows(seed=1):
    rng = random.Random(seed)
    out = [(k, prose(rng, rng.randrange(0, 60)), "en", f"src{rng.choice([0, 0, 0, 1, 2, 10])}") for k in range(300)]
    return out + [(900, None, "en", "src0"), (901, "", "en", None), (902, "a b\x0bc  ", "en", None), (903, " \n", "en", "only"),
                  (904, "é é", "en", "É"), (905, "z", "en", "Z"), (905, "z", "en", "Z"), (None, "q q q", "en", "Z")]


def check(got, want_rows):
    size = {}
    for r in want_rows:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    goal = targets(size)
    taken = {}
    for r in got:
        s = r.source
        assert r.source_size == size[s] and abs(r.target - goal[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in size)


def mixed(df, **kw):
    return mix_sources(df, carry=["doc_id", "source"], **kw).toDF(
        "doc_id", "source", "size", "source_size", "target", "taken")


def test_targets_and_exact_cut(documents):
    r = rows()
    got = mixed(documents(r)).collect()
    assert len(got) == len(r)
    assert {g.doc_id: g.size for g in got if g.doc_id not in (905, None)} == {
        x[0]: len(words(x[1])) for x in r if x[0] not in (905, None)}
    check(got, r)


def test_reruns_and_partitionings_agree(documents):
    df = documents(rows(2))
    a = sorted(mixed(df).collect(), key=str)
    assert a == sorted(mixed(df.repartition(7)).collect(), key=str)
    assert a == sorted(mixed(df, intervals=3).collect(), key=str)
    assert a != sorted(mixed(df, seed=9).collect(), key=str)


def test_one_source_many_weights(documents):
    r = [(k, "a b c", "en", "s") for k in range(10)]
    check(mixed(documents(r)).collect(), r)
    assert sum(x.taken for x in mixed(documents(r)).collect()) == 45


def test_mixed_rows_hold_the_words_taken(documents):
    r = rows(3)
    df = documents(r)
    taken = {}
    for x in mixed(df).collect():
        taken[x.doc_id] = taken.get(x.doc_id, 0) + x.taken
    out = mixed_rows(df)
    assert out.columns == df.columns
    got = {}
    for x in out.collect():
        got[x.doc_id] = got.get(x.doc_id, 0) + len(words(x.text))
    assert got == {k: v for k, v in taken.items() if v}


def test_empty_and_all_null(documents):
    assert mix_sources(documents([])).count() == 0 and mixed_rows(documents([])).count() == 0
    r = [(1, None, None, None), (2, None, None, "x")]
    assert [x.taken for x in mixed(documents(r)).collect()] == [0, 0]
    clash = documents([(1, "a b", "en", "s", 3, 4)], ", size long, taken long")
    assert mixed_rows(clash).columns == clash.columns
