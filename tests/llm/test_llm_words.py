"""Vectorised scanning against regular expressions, piece borders included."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemart.llm import words as W

ALNUM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPACED = re.compile(rb"[^\x20\x09-\x0d]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9é\n\t-.\x00ß漢", max_size=40)), max_size=8)


def expected(texts, pattern, lower):
    out = []
    for t in texts:
        raw = (t or "").encode()
        if lower:
            raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), raw)
        out.append(pattern.findall(raw))
    return out


def found(w):
    raw = w.data.tobytes()
    return [[raw[s:e] for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]


@pytest.mark.parametrize("piece", [1 << 20, 7, 1])
@settings(max_examples=60, deadline=None, derandomize=True)
@given(texts=TEXTS)
def test_scan_matches_regex_for_any_piece_size(piece, texts):
    before, W.PIECE = W.PIECE, piece
    try:
        for table, pattern, lower in ((W.alnum_table(), ALNUM, True), (W.whitespace_table(), SPACED, False)):
            w = W.scan(pa.array(texts, pa.string()), table, lower)
            assert found(w) == expected(texts, pattern, lower)
            by_hash = {}
            for h, word in zip(w.hash.tolist(), [x for row in found(w) for x in row]):
                assert by_hash.setdefault(h, word) == word
            assert len(set(by_hash.values())) == len(by_hash)
    finally:
        W.PIECE = before


def test_windows_stay_inside_a_row_and_hash_by_words():
    w = W.scan(pa.array(["a b c d", None, "b c", "x  b\tc d"]), W.whitespace_table(), False)
    h, at = W.windows(w, 3)
    assert at.tolist() == [0, 1, 6, 7]
    assert h[1] == h[3] and len(set(h.tolist())) == 3
    assert W.row_of(w, at).tolist() == [0, 0, 3, 3]
    assert len(W.windows(w, 9)[0]) == 0


def test_slices_cover_all_rows_once():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * n for n in (5, 100, 1, 0, 60, 60)], "i": list(range(6))})
    parts = list(W.slices(batch, "t", 100))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(6))
    assert max(p.num_rows for p in parts) < 6
    assert np.concatenate([W.utf8(p.column("t"))[0] for p in parts]).size == 226
