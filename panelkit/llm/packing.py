"""Order-preserving sequence packing by dynamic programming with a monotone queue.

Texts become token ids, in their order, and end with an end-of-text id. The stream of a segment
of texts is cut into windows of at most ``length`` ids. Cuts lie at document ends and
sentence ends (a longer sentence is cut at full windows). With c(j) the least cost of the stream up to cut j,

    c(j) = penalty(j) + per_window + min over earlier cuts i, j - i <= length, of c(i) + padding(j - i)

Padding to full length is length - (j - i), so the minimum over the sliding range is the
front of a monotone queue of c(i) + i. A window whose length is a power of two
needs no padding; those few earlier cuts are looked up directly.

A segment is a bounded run of rows inside one input partition, so nothing is shuffled, memory is
bounded, and a lost task is done again with the same result.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import small_batches, tidy

END_OF_TEXT = 0


def window_cuts(at: np.ndarray, penalty: np.ndarray, length: int, per_window: float = 0.0) -> list[int]:
    """Least-cost cuts of a stream. ``at``: increasing possible cuts, from 0 to the end of the stream, no two
    neighbours further apart than ``length``; ``penalty``: cost of a cut there. Returns the indices
    into ``at`` of the chosen cuts, the first and last included. ``per_window`` is
    the cost of one more window, which keeps short windows of a power of two rare."""
    at = np.asarray(at)
    n = len(at)
    # the earlier cuts a power of two away, as a list per cut
    to, frm = [], []
    for k in range(length.bit_length()):
        i = np.searchsorted(at, at - (1 << k))
        j = np.flatnonzero((at >= 1 << k) & (at[np.minimum(i, n - 1)] == at - (1 << k)))
        to.append(j), frm.append(i[j])
    to, frm = np.concatenate(to), np.concatenate(frm)
    order = np.argsort(to, kind="stable")
    first = np.searchsorted(to[order], np.arange(n + 1)).tolist()
    exact = frm[order].tolist()
    at, penalty = at.tolist(), (np.asarray(penalty, float) + per_window).tolist()
    cost, back = [0.0] * n, [0] * n
    queue = deque([(0.0, 0, 0)])
    for j in range(1, n):
        p = at[j]
        while queue[0][1] < p - length:
            queue.popleft()
        best, _, i = queue[0]
        best += length - p
        for k in exact[first[j]:first[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        best += penalty[j]
        cost[j], back[j] = best, i
        key = best + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, p, j))
    out = [n - 1]
    while out[-1]:
        out.append(back[out[-1]])
    return out[::-1]


#: Texts with a run of that much white space are left to the tokenizer: the other encoder's search has a bounded stack.
LONG_GAP = 100_000

#: Fixed value: the pre-tokenisation pattern of byte-level BPE files of this kind.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters such files write for the 256 bytes: printable bytes as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenStream:
    """Token ids of texts under a byte-level BPE file.

    A text is encoded in one call from the file's merges, cut by the file's own pattern; the ids become an array at
    once, so a worker holds the Python numbers of one text at a time. Texts of at most 24 characters are remembered (at most
    ``remember``). A text with a special token, or with a run of white space too long for the search of ``parts``, is
    encoded by the tokenizer itself.
    """

    def __init__(self, path: str, remember: int = 1 << 17):
        import json
        import os
        import re
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        import tiktoken
        from tokenizers import Tokenizer
        self.tok, self.remember = Tokenizer.from_file(path), remember
        before = json.loads(self.tok.to_str())
        pre = before.get("pre_tokenizer") or {}
        if (before.get("normalizer"), pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) != (None, "ByteLevel", False, True):
            raise ValueError(f"{path} does not cut texts as byte-level BPE files of this kind do")
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.whole = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        self.gap = re.compile(r"(?<!\s)\s{%d}" % LONG_GAP)
        vocab, letters = self.tok.get_vocab(), byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.parts = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, np.ndarray] = {}
        ends = np.zeros(max(vocab.values()) + 1, bool)
        for t, i in vocab.items():
            ends[i] = t.endswith((".", "!", "?", "\u010a"))  # the last stands for a line feed
        self.sentence_end = ends

    def ids(self, text: str) -> np.ndarray:
        x = self.known.get(text)
        if x is not None:
            return x
        if self.whole.search(text) or len(text) >= LONG_GAP and self.gap.search(text):
            x = self.tok.encode(text, add_special_tokens=False).ids
        else:
            x = self.parts(text)
        x = np.frombuffer(array("I", x), "<u4")
        if len(text) <= 24:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[text] = x
        return x

    def encode(self, col: pa.Array, unit: int = 1 << 20) -> list[np.ndarray]:
        """Ids of each text; about ``unit`` bytes of texts are Python strings at a time, or one longer text."""
        size, out, i = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False)), [], 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + unit, "right")))
            out += map(self.ids, col.slice(i, j - i).to_pylist())
            i = j
        return out


def segment_pieces(docs: list[np.ndarray], length: int, sentence_end: np.ndarray, cut_sentence: float,
                   cut_inside: float, per_window: float):
    """Windows of one segment: arrays (doc, start, size, window, offset), one entry per piece."""
    sizes = np.array([len(d) + 1 for d in docs])
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    stop = np.zeros(total + 1, np.float32)
    flags = [np.append(sentence_end[d], False) for d in docs]
    marks = np.flatnonzero(np.concatenate(flags)) + 1
    at = np.union1d(np.union1d(marks, ends), [0])
    gaps = np.diff(at)
    far = np.flatnonzero(gaps > length)
    if len(far):  # sentences longer than a window
        at = np.union1d(at, np.concatenate([np.arange(at[k] + length, at[k + 1], length) for k in far]))
    stop[:] = cut_inside
    stop[marks] = cut_sentence
    stop[ends] = 0.0
    cuts = at[window_cuts(at, stop[at], length, per_window)]
    edges = np.union1d(cuts, np.concatenate([[0], ends]))
    s, size = edges[:-1], np.diff(edges)
    doc = np.searchsorted(ends, s, "right")
    win = np.searchsorted(cuts, s, "right") - 1
    return doc, s - (ends[doc] - sizes[doc]), size, win, s - cuts[win]


def pack_sequences(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", tokenizer: str,
                   length: int = 1024, cut_sentence: float = 4.0, cut_inside: float = 16.0, per_window: float = 16.0,
                   segment_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file, the same on driver and executors. Null text is empty: its
    one id is the end of text. Rows keep their order inside a partition; sequences never span segments of about
    ``segment_bytes`` of text. Repeated rows and null ids are rows like others. sequence_id numbers
    sequences within their partition (partition * 2**33 + number). Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        from pyspark import TaskContext
        stream, seq = TokenStream(tokenizer), TaskContext.get().partitionId() << 33

        def segment(parts):
            nonlocal seq
            ids, texts = (pa.concat_arrays([p.column(k) for p in parts]) for k in (0, 1))
            toks = stream.encode(texts)
            doc, start, size, win, offset = segment_pieces(toks, length, stream.sentence_end, cut_sentence,
                                                           cut_inside, per_window)
            data = [np.append(t, np.uint32(END_OF_TEXT)).astype("<u4") for t in toks]
            crc = [zlib.crc32(data[d][s:s + n]) for d, s, n in zip(doc.tolist(), start.tolist(), size.tolist())]
            tokens = np.array([len(d) for d in data])
            out = pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                 pa.array(tokens[doc]), pa.array(win + seq), pa.array(offset)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            seq += int(win[-1]) + 1
            return out

        parts, held = [], 0
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                base = size[first - 1] if first else 0
                end = int(np.searchsorted(size, base + segment_bytes - held)) + 1
                parts.append(batch.slice(first, end - first))
                held += int(size[min(end, batch.num_rows) - 1] - base)
                if end <= batch.num_rows:
                    yield segment(parts)
                    parts, held = [], 0
                first = end
        if parts:
            yield segment(parts)

    out = rows.mapInArrow(tidy(run), f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                               "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
