"""Words, hashes and runs against regular expressions."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from campuswatt.llm import text as X
from campuswatt.llm.common import pack, unpack
from fixtures import words

TEXT = st.text(alphabet="abAB \t\n\x0b\x0c\r\x1cé ,.", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=8))
def test_words_and_hashes(rows):
    found, names = [], {}
    for _, offsets, data in X.chunks(pa.array(rows, pa.string()), limit=20):
        starts, ends, counts = X.spans(data, offsets)
        split = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
        for w, h in zip(split, X.hashes(data, starts, ends, lower=True).tolist()):
            low = w.translate({i: i + 32 for i in range(65, 91)})
            assert names.setdefault(low, h) == h
        at = 0
        for c in counts:
            found.append(split[at:at + c])
            at += c
    assert found == [words(r) for r in rows]
    assert len(set(names.values())) == len(names)


def test_windows_and_pack():
    v = X.mix(np.arange(50, dtype=np.uint64))
    grams = X.windows(v, 5)
    assert len(grams) == 46 and len(set(grams.tolist())) == 46
    assert X.windows(np.tile(v[:5], 3), 5)[0] == X.windows(np.tile(v[:5], 3), 5)[5]
    assert len(X.windows(v[:4], 5)) == 0
    assert (unpack(pack(v, 8), 8) == v).all() and (unpack(pack(v, 3), 3) == v % np.uint64(1 << 24)).all()


def test_empty_column():
    assert list(X.chunks(pa.array([], pa.string()))) == []
    (_, offsets, data), = X.chunks(pa.array([None], pa.string()))
    assert offsets.tolist() == [0, 0] and len(data) == 0
