import random

import numpy as np
import pytest

import corpus_pipeline as cp
from panelkit.session import cut_lineage
from tests.llm.brute import LOWER, components, jaccard_components, shingles, words
from tests.llm.conftest import prose
from tests.llm.test_packing import check


def corpus():
    rng = random.Random(11)
    rows = [(k, prose(rng, rng.randrange(1, 80), 3000), rng.choice(["en", "de"]), f"src{rng.choice([0, 0, 0, 1, 2])}")
            for k in range(120)]
    rows += [(200 + k, rows[k][1].upper(), "en", "src1") for k in range(10)]  # exact copies
    long = prose(rng, 150, 10**5)
    rows += [(300 + k, long + f" end{k}", "en", "src2") for k in range(15)]  # near copies
    return rows + [(400, None, "en", "src0"), (401, " 12 34 .", "en", "src0"), (402, "", None, None)]


def test_every_stage_against_brute_force(spark, documents):
    assert [n for n, _ in cp.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]
    rows = corpus()
    docs = cut_lineage(documents(rows))
    seen = {}
    for name, stage in cp.STAGES:
        out = cut_lineage(stage(spark, docs, "unused"))
        seen[name] = (docs, out)
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    text = {r[0]: r[1] for r in rows}

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    with_letters = sorted(i for i, t in text.items() if t and any(c.isalpha() for c in t))
    assert ids(seen["language ID"][1]) == with_letters
    first = {}
    for i in with_letters:
        first.setdefault(text[i].translate(LOWER), i)
    assert ids(seen["exact dedup"][1]) == sorted(first.values())
    want = jaccard_components({i: text[i] for i in first.values()})
    assert ids(seen["n-gram Jaccard join"][1]) == sorted(i for i, (_, c) in want.items() if i == c)
    mixed = [(r.doc_id, r.text) for r in seen["mixing"][1].collect()]
    n_in = sum(len(words(r.text)) for r in seen["mixing"][0].collect())
    assert sum(len(words(t)) for _, t in mixed) == pytest.approx(1.5 * n_in, abs=3)
    assert all(text[i] == t or text[i].startswith(t) for i, t in mixed)
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {i for i, t in mixed if t == text[i] and sum(x == i for x, _ in mixed) == 1}
    pieces = seen["packing"][1].filter("doc_id is not null").collect()
    total = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed)
    assert sum(p.length for p in pieces) == total
    assert whole and {p.doc_id for p in pieces} == {i for i, _ in mixed}
    assert np.unique([p.sequence_id for p in pieces]).size >= total // 1024 and callable(check)


def test_run_equals_the_stages_and_empty_input(spark, documents, tmp_path):
    documents(corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() > 0
    documents([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0


def test_near_copies_share_80_percent_of_five_words(documents):
    rng = random.Random(12)
    text, stage = {}, dict(cp.STAGES)["n-gram Jaccard join"]
    for k in range(40):  # with a block at the end: five-word Jaccard 0.78 to 0.90
        base = prose(rng, 200, 10**6)
        text[2 * k] = base
        text[2 * k + 1] = base + " " + prose(rng, 22 + k * 33 // 40, 10**6)
    for k in range(40):  # single words replaced
        base = prose(rng, 230, 10**6).split()
        text[200 + 2 * k] = " ".join(base)
        for i in range(10, 230, 40 + k):
            base[i] = f"x{i}"
        text[201 + 2 * k] = " ".join(base)
    sets = {i: shingles(t, 5) for i, t in text.items()}
    links = [(i, i + 1) for i in text if i % 2 == 0
             and 100 * len(sets[i] & sets[i + 1]) >= 80 * len(sets[i] | sets[i + 1])]
    assert 20 < len(links) < 80
    want = sorted(i for i, c in components(text, links).items() if i == c)
    assert sorted(r.doc_id for r in stage(None, documents(sorted(text.items())), "unused").collect()) == want
    four = {i for i, (_, c) in jaccard_components(text).items() if i == c}
    assert four - set(want)  # copies that only these bounds find
