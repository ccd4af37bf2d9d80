import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelkit.llm.packing import TokenStream, pack_sequences, segment_pieces, window_cuts
from tests.llm.conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a\n\n b", "a \nb", "it's  we'll\t x", "<|endoftext|>",
       "a <|endoftext|> b", "été 😀 ñ", "x y  z", "a\r\n\r\n b c", "1 22 333,  4.", "　全角 空白", "ſ ß́ é"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_stream_equals_the_tokenizer(tok):
    rng = random.Random(1)
    chars = list(" \n\tab'é1.,<|😀 ") + ["  ", "ll", "'s", "the"]
    texts = ODD + ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(600)] + [prose(rng, 500)]
    for remember in (5, 10**6):
        stream = TokenStream(PATH, remember)
        for _ in range(2):
            got = stream.encode(pa.array(texts))
            assert [g.tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def cost(at, penalty, cuts, length, per):
    size = np.diff([at[c] for c in cuts])
    pad = [0 if s & (s - 1) == 0 else length - s for s in size]
    return sum(pad) + sum(penalty[c] + per for c in cuts[1:])


def test_cuts_are_optimal():
    rng = random.Random(2)
    for _ in range(150):
        length = rng.choice([4, 8, 16])
        at = [0]
        for _ in range(rng.randrange(1, 9)):
            at.append(at[-1] + rng.randrange(1, length + 1))
        penalty = [rng.choice([0.0, 1.0, 3.0]) for _ in at]
        per = rng.choice([0.0, 2.0])
        best = float("inf")
        for k in range(len(at)):
            for mid in itertools.combinations(range(1, len(at) - 1), k):
                cuts = [0, *mid, len(at) - 1]
                if all(at[b] - at[a] <= length for a, b in zip(cuts, cuts[1:])):
                    best = min(best, cost(at, penalty, cuts, length, per))
        got = window_cuts(at, penalty, length, per)
        assert all(at[b] - at[a] <= length for a, b in zip(got, got[1:]))
        assert cost(at, penalty, got, length, per) == pytest.approx(best)


def test_long_sentences_are_cut_at_full_windows():
    ends = np.zeros(10, bool)
    doc, start, size, win, offset = segment_pieces([np.ones(5000, np.uint32)], 1024, ends, 4.0, 16.0, 16.0)
    assert size.sum() == 5001 and size.max() <= 1024 and (start == np.concatenate([[0], np.cumsum(size)[:-1]])).all()


def check(rows, got, tok, length=1024):
    ids = {}
    for i, t in rows:
        ids.setdefault(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    by, seqs = {}, {}
    for r in got:
        a = ids[r.doc_id]
        assert r.doc_tokens == len(a) and zlib.crc32(a[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        by.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, pieces in by.items():
        assert sum(n for _, n in pieces) == len(ids[i]) * sum(x[0] == i for x in rows)
    assert set(by) == set(ids)
    for pieces in seqs.values():
        end = 0
        for o, n in sorted(pieces):
            assert o == end
            end += n
        assert end <= length


def test_pieces_cover_every_id_once(documents, odd_rows, tok):
    rows = odd_rows + [(1000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (5000, "twice"), (5000, "twice")]
    for kw in ({}, {"segment_bytes": 500}):
        check(rows, pack_sequences(documents(rows), tokenizer=PATH, **kw).collect(), tok)
    got = pack_sequences(documents(rows), tokenizer=PATH, length=64).collect()
    check(rows, got, tok, 64)


def test_little_padding_and_same_result_again(documents, tok):
    rng = random.Random(4)
    rows = [(k, ". ".join(prose(rng, rng.randrange(3, 15)) for _ in range(rng.randrange(1, 40)))) for k in range(300)]
    df = documents(rows).coalesce(1)
    got = pack_sequences(df, tokenizer=PATH).collect()
    assert got == pack_sequences(df, tokenizer=PATH).collect()
    size = {}
    for r in got:
        size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
    padding = sum(1024 - s for s in size.values() if s & (s - 1))
    assert padding < 0.03 * sum(size.values())


def test_empty_table_and_clashing_columns(documents):
    assert pack_sequences(documents([]), tokenizer=PATH).count() == 0
    clash = documents([(1, "a", "en", "s", "u", 3)], ", start string, length long")
    assert [r.length for r in pack_sequences(clash, tokenizer=PATH).collect()] == [2]


def test_a_file_with_other_pieces_is_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        TokenStream(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_do_not_depend_on_how_many_texts_are_in_work_at_a_time():
    texts = ["", "one two three", "a  b", "x" * 500, "one two two. Three!\nfour", " lead", "tail "] * 7
    stream = TokenStream(PATH, remember=4)
    whole = [t.ids for t in stream.tok.encode_batch(texts, add_special_tokens=False)]
    for unit in (1, 30, 1 << 20):
        assert [x.tolist() for x in stream.encode(pa.array(texts), unit)] == whole
        assert [x.tolist() for x in stream.encode(pa.array(texts).slice(3), unit)] == whole[3:]


def test_a_text_is_encoded_in_one_call_and_long_white_space_runs_are_encoded_too(tok):
    stream, calls = TokenStream(PATH), []
    parts = stream.parts
    stream.parts = lambda t: calls.append(t) or parts(t)
    texts = [" ".join(f"w{k} x{k}y" for k in range(500)), "two  spaces \n and\u3000 more\xa0 \u2028 white", "a"]
    assert [x.tolist() for x in stream.encode(pa.array(texts))] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert calls == texts
    for t in ("\n" * 1_200_000 + "a", "b" + " " * 300_000 + "a"):
        assert stream.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_texts_come_to_python_in_small_batches(spark, documents):
    def shapes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = documents([(k, "word " * 2000) for k in range(3000)]).coalesce(1).cache()
    pack_sequences(docs, tokenizer=PATH)
    seen = [r.n for r in docs.select("text").mapInArrow(shapes, "n long").collect()]
    assert sum(seen) > 3000 * 10_000 and max(seen) < 6 << 20
    spark.conf.set(key, str(1 << 20))
    pack_sequences(docs, tokenizer=PATH)
    assert spark.conf.get(key) == str(1 << 20)
    spark.conf.unset(key)
