import pytest
from pyspark.sql import functions as F

from panelkit.llm.common import mark_possible
from panelkit.llm.exact_dedup import drop_copies, exact_dedup, tree_merge
from panelkit.session import cut_lineage
from tests.llm.brute import LOWER, sha


def expected(rows, largest):
    by = {}
    for i, t in rows:
        by.setdefault((t or "").translate(LOWER), []).append(i)
    pick = max if largest else min
    return {i: (pick(m), len(m), i == pick(m), sha(t)) for t, m in by.items() for i in m}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_every_row_meets_its_survivor(documents, odd_rows, keep):
    got = exact_dedup(documents(odd_rows), keep=keep).collect()
    want = expected(odd_rows, keep == "largest")
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want
    assert len(got) == len(odd_rows)


@pytest.mark.parametrize("runs,fan", [(1, 1), (8, 1), (16, 3), (5, 2)])
def test_any_tree_gives_the_same(documents, odd_rows, runs, fan):
    got = exact_dedup(documents(odd_rows), runs=runs, fan_bits=fan).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == expected(odd_rows, False)


def test_repeated_and_null_ids_keep_exactly_one_row(documents):
    rows = [(1, "x"), (1, "X"), (None, "x"), (None, "y"), (None, "y"), (3, "z"), (2, "z")]
    for keep in ("smallest", "largest"):
        got = exact_dedup(documents(rows), keep=keep).collect()
        assert sum(r.kept for r in got) == 3
        assert all(r.keep_id == 1 for r in got if r.text_sha256 == sha("x"))
        assert {r.keep_id for r in got if r.text_sha256 == sha("z")} == {2 if keep == "smallest" else 3}
        kept = drop_copies(documents(rows), keep=keep).collect()
        assert sorted((r.text or "").lower() for r in kept) == ["x", "y", "z"]


def test_short_digest_clash_does_not_merge(spark):
    entries = spark.createDataFrame(
        [(r, 7, bytes([s]), 1, (True, 10 * r + s, r), 1) for r in range(4) for s in (1, 2)],
        "__run int, __d64 long, __sha binary, __len int, __pick struct<p:boolean,id:long,u:long>, __n long")
    got = tree_merge(entries, 4, 1, True).collect()
    assert sorted((bytes(r["__sha"]), r["__pick"].id, r["__n"]) for r in got) == [(b"\1", 31, 4), (b"\2", 32, 4)]


def test_hot_text_empty_table_and_clashing_columns(documents):
    rows = [(k, "same") for k in range(300)] + [(300 + k, f"own {k}") for k in range(100)]
    got = exact_dedup(documents(rows)).collect()
    assert sum(r.kept for r in got) == 101 and {r.group_size for r in got} == {300, 1}
    assert exact_dedup(documents([])).count() == 0 and drop_copies(documents([])).count() == 0
    extra = documents([(1, "a", "en", "s", 5, True), (2, "A", None, None, 6, False)],
                      ", keep_id long, kept boolean")
    assert [r.keep_id for r in exact_dedup(extra, carry=["doc_id", "keep_id"]).collect()] == [1, 1]
    assert drop_copies(extra).columns == extra.columns and drop_copies(extra).first().keep_id == 5


def test_no_python_on_the_main_path(documents):
    plan = exact_dedup(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert F.lit(1) is not None


def test_rows_go_without_python(documents):
    kept = drop_copies(documents([(1, "a"), (2, "A"), (3, "b")]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_the_filter_loses_no_key_and_lets_few_others_pass(spark):
    keys = cut_lineage(spark.range(20_000).selectExpr("cast(id as string) both"))
    rows = spark.range(40_000).selectExpr("id", "cast(id as string) both")
    got = mark_possible(rows, keys, "both").selectExpr("id < 20000 own", "may").groupBy("own").agg(F.count_if("may").alias("n")).collect()
    n = {r.own: r.n for r in got}
    assert n[True] == 20_000 and n[False] < 1_000
    none = mark_possible(rows, keys.limit(0), "both")
    assert none.columns == ["id", "both", "may"] and none.filter("may").count() == 0 and none.count() == 40_000
