"""Operators of the third round against plain versions."""

import random
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from panelkit.operators import match as mt


def test_lcs_in_the_jvm(spark):
    rng = random.Random(1)
    rows = [("", ""), ("a", ""), ("", "b"), (None, "x"), ("tskbti", "tskbis"), ("é😀b", "😀é b"), ("ab" * 62, "ba" * 70)]
    for _ in range(150):
        rows.append(tuple("".join(rng.choice("abcdé😀") for _ in range(rng.choice([3, 10, 61, 62, 63, 124, 130]))) for _ in range(2)))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", mt.similarity("a", "b").alias("s")).collect()
    assert all(r.s == mt.ratio(r.a, r.b) for r in got)


def brute_best(tokens, names, score, block=3):
    out = {}
    for t in set(tokens):
        found = [(-score(t.lower(), n.lower()), n) for n in names if n.lower()[:block] == t.lower()[:block]]
        if found:
            s, n = min(found)
            out[t] = (n, -s)
    return out


def edit_score(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    n = max(len(a), len(b))
    return int(100 * (1 - row[-1] / n) + 0.5) if n else 100


def test_best_match_scores_only_lengths_that_can_win(spark):
    rng = random.Random(2)

    def word():
        return rng.choice(["abc", "abd", "Xyz"]) + "".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 25)))
    tokens, names = [word() for _ in range(120)] + ["abc", "ab", "zzz"], [word() for _ in range(90)] + ["abc", "ab"]
    t, n = spark.createDataFrame([(x,) for x in tokens + tokens[:9]], "t string"), spark.createDataFrame([(x,) for x in names], "n string")
    for kind, score in (("levenshtein", edit_score), ("ratio", mt.ratio)):
        got = {r.token: (r.best_match, r.score) for r in mt.best_match(t, n, "t", "n", score=kind).collect()}
        assert got == brute_best(tokens, names, score)


def test_contains_match_in_many_automata(spark):
    rng = random.Random(3)
    tokens = ["".join(rng.choice("abé") for _ in range(rng.randrange(0, 4))) for _ in range(60)] + [None, "A"]
    names = [(k, "".join(rng.choice("abcéÉ ") for _ in range(rng.randrange(0, 9)))) for k in range(50)] + [(99, None), (98, "")]
    want = sorted({(t.lower(), k) for t in tokens if t for k, n in names if n is not None and t.lower() in n.lower()})
    t, n = spark.createDataFrame([(x,) for x in tokens], "t string"), spark.createDataFrame(names, "k long, n string")
    for size in (1000, 7):
        got = mt.contains_match(t, n, "t", "n", ["k"], shard=size, stream=size).collect()
        assert sorted((r.token, r.k) for r in got) == want


def test_trade_dates_need_digits(spark):
    texts = {"+1/05/20 x": None, "13/01/20 02/30/20 1/2/20 03/04/21": "absent", "a 01/02/99z 03/03/03": "2099-01-02",
             "12/31/07": "2007-12-31", "1 /2/20": None, "-1/-2/20": None, "": None}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.trade_date for r in mt.extract_trade_fields(df, "text").collect()}
    for t, want in texts.items():
        # a date token whose month has no such day is the first token, and no date
        assert (None if got[t] is None else str(got[t])) == (None if want == "absent" else want), t


def test_entry_without_the_training_data_package():
    code = """
        import importlib.util, sys
        real = importlib.util.find_spec
        importlib.util.find_spec = lambda name, package=None: None if name.startswith("panelkit.llm") else real(name, package)
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name.startswith("panelkit.llm"):
                    raise ModuleNotFoundError(name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert "pipeline" not in e.queries() and not any(q.startswith("op1_") for q in e.queries())
        assert set(e.oracle_sql()) <= set(e.queries())
        print("entry imports", len(e.queries()))
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert "entry imports" in out.stdout, out.stderr[-2000:]
