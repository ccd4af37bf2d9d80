import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm.langid import Alphabet, CrossParser, encode, identify, learn, suffix_automaton

SYL = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "er"], "cc": ["ción", "ñe", "os", "ar"]}


def text(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYL[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def plain_phrases(sample, z):
    """Fewest pieces by longest match: greedy parsing with substring search."""
    n, i = 0, 0
    while i < len(z):
        j = i + 1
        while j <= len(z) and z[i:j] in sample:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(20):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        t = suffix_automaton(s, 3)
        have = {tuple(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for _ in range(200):
            z = [rng.randrange(3) for _ in range(rng.randrange(1, 6))]
            state = 0
            for c in z:
                state = int(t[state, c]) if state != 0xFFFF else state
            assert (state != 0xFFFF) == (tuple(z) in have)


def test_phrase_counts_match_plain_parsing():
    rng = random.Random(2)
    samples = {k: text(rng, k, 200) for k in SYL}
    alphabet = Alphabet(list(samples.values()))
    tables = [suffix_automaton(encode(alphabet.table, [s])[0].tolist(), alphabet.size) for s in samples.values()]
    texts = [text(rng, k, 20) for k in SYL] + ["", "ka", "123 ka!"]
    sym, ends = encode(alphabet.table, texts)
    got = CrossParser(tables, 10**6).phrases(sym, ends)
    plain = [bytes(encode(alphabet.table, [s])[0].tolist()) for s in samples.values()]
    starts = np.concatenate([[0], ends[:-1]])
    for k in range(len(texts)):
        z = bytes(sym[starts[k]:ends[k]].tolist())
        for m, s in enumerate(plain):
            if all(bytes([c]) in s for c in z):
                assert got[k, m] == plain_phrases(s, z)


def test_held_out_accuracy_nulls_and_odd_texts(documents):
    rng = random.Random(3)
    rows = [(k, text(rng, lang), lang) for k, lang in enumerate(rng.choice(list(SYL)) for _ in range(300))]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (1003, text(rng, "cc", 9000), None),
           (None, text(rng, "bb"), "aa"), (1004, "漢字", None)]
    out = identify(documents(rows + odd)).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) + len(odd)
    for i, _, lang in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang and 0 <= got[i].score <= 1
    assert [got[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003].lang_pred == "cc" and got[None].lang_pred == "bb" and got[None].held_out is False


def test_held_out_labels_and_other_columns_teach_nothing(documents):
    rng = random.Random(4)
    rows = [(k, text(rng, "aa" if k % 2 else "bb"), "aa" if k % 2 else "bb", "s") for k in range(200)]
    lied = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, f"src{i}") for i, t, lang, _ in rows]

    def run(r):
        return sorted((x.doc_id, x.lang_pred, x.score) for x in identify(documents(r)).collect())

    assert run(rows) == run(lied)


def test_nothing_to_learn_empty_table_and_names(documents):
    none = identify(documents([(1, "abc", None)])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert identify(documents([])).count() == 0
    clash = documents([(1, "ka lo", "aa", "s", "x", 5.0)], ", lang_pred string, score double")
    r = identify(clash, names=("h", "p", "q")).first()
    assert (r.lang_pred, r.score, r.p) == ("x", 5.0, "aa")
    assert identify(clash).first().lang_pred == "aa"


def test_every_letter_of_the_sample_is_a_symbol():
    rng = random.Random(5)
    han = [chr(0x4E00 + k) for k in range(300)]
    samples = ["".join(rng.choice(han) for _ in range(2000)), text(rng, "bb", 200), text(rng, "cc", 200) + " İ"]
    alphabet = Alphabet(samples)
    codes = {int(alphabet.table[ord(c)]) for s in samples for c in s if c.isalpha()}
    assert len(codes) == alphabet.size - 2 and min(codes) == 2
    assert alphabet.table[ord("я")] == 1 and alphabet.table[ord("E")] == alphabet.table[ord("e")]
    enc = [encode(alphabet.table, [s])[0].tolist() for s in samples]
    tables = [suffix_automaton(s, alphabet.size) for s in enc]
    have = {tuple(enc[0][i:j]) for i in range(len(enc[0])) for j in range(i + 1, min(i + 4, len(enc[0])) + 1)}
    for _ in range(500):
        i = rng.randrange(len(enc[0]) - 4)
        z = enc[0][i:i + 3] if rng.random() < 0.5 else enc[0][i:i + 2] + [rng.randrange(2, alphabet.size)]
        state = 0
        for c in z:
            state = tables[0][state, c] if state != 0xFFFF else state
        assert (state != 0xFFFF) == (tuple(z) in have)
    texts = [samples[0][50:90] + samples[0][500:520], "".join(rng.choice(han) for _ in range(80)), text(rng, "bb", 20), "x" + han[0]]
    sym, ends = encode(alphabet.table, texts)
    got = CrossParser(tables, 10**6).phrases(sym, ends)
    starts = np.concatenate([[0], ends[:-1]])
    plain = ["".join(map(chr, s)) for s in enc]
    for k in range(len(texts)):
        z = "".join(map(chr, sym[starts[k]:ends[k]].tolist()))
        for m, s in enumerate(plain):
            if set(z) <= set(s):
                assert got[k, m] == plain_phrases(s, z)


def test_languages_of_several_scripts_are_told_apart(documents):
    rng = random.Random(6)
    letters = {"el": [chr(0x3B1 + k) for k in range(17)], "ru": [chr(0x430 + k) for k in range(32)],
               "ja": [chr(0x3041 + k) for k in range(80)], "zh": [chr(0x4E00 + 7 * k) for k in range(400)]}
    pairs = {x: [a + rng.choice(c) for a in c] for x, c in letters.items()}

    def some(lang):
        return text(rng, lang, 40) if lang in SYL else " ".join("".join(rng.choices(pairs[lang], k=3)) for _ in range(40))

    rows = [(k, some(x), x) for k, x in enumerate([*SYL, *letters] * 40)]
    got = {r.doc_id: r.lang_pred for r in identify(documents(rows)).collect()}
    assert [got[i] for i, _, _ in rows] == [x for _, _, x in rows]


def test_copies_take_one_place_among_the_teachers(documents):
    rng = random.Random(7)
    rows = [(k, text(rng, "aa" if k % 2 else "bb"), "aa" if k % 2 else "bb") for k in range(400)]
    first = documents(rows).filter("lang = 'aa'").orderBy(F.xxhash64("text")).first().text
    copies = [(1000 + k, first, "aa") for k in range(400)]

    def taught(r):
        langs, alphabet, tables = learn(documents(r), "text", "doc_id", "lang", 150, 30_000)
        return langs, alphabet.table, [t.table for t in tables]

    one, many = taught(rows + copies[:20]), taught(rows + copies)
    assert one[0] == many[0] == ["aa", "bb"] and (one[1] == many[1]).all()
    assert all(np.array_equal(a, b) for a, b in zip(one[2], many[2])) and len(many[2][0]) > 10_000


def test_result_does_not_depend_on_how_many_texts_are_in_work_at_a_time(documents):
    rng = random.Random(8)
    rows = [(i, text(rng, lang, n), lang) for i in range(20) for lang in SYL for n in (1, 40)]
    rows = [(k, t, lang) for k, (_, t, lang) in enumerate(rows)] + [(900, None, None), (901, "", "aa"), (902, "12 3", None)]
    one, all_ = ({r.doc_id: (r.lang_pred, r.score) for r in identify(documents(rows), unit=u).collect()} for u in (1, 1 << 20))
    assert one == all_ and len(one) == len(rows)
