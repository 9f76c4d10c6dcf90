"""Suffix-array dedup against counting all strings of 200 bytes."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from campuswatt.llm import suffix_dedup as D
from fixtures import SCHEMA, awkward, documents, texts


def brute(rows, length):
    raw = [(t or "").encode() for t in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_of_small_alphabets():
    rng = np.random.default_rng(0)
    for trial in range(150):
        data = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(2, 400))).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[:max(1, len(data) // 3)], 4)
        n, depth = len(data), int(rng.integers(8, 40))
        valid = np.zeros(n, dtype=bool)
        last = max(0, n - depth + 1)
        valid[:last] = rng.random(last) < 0.7
        raw = data.tobytes()
        seen = Counter(raw[i:i + depth] for i in range(n) if valid[i])
        want = np.array([valid[i] and seen[raw[i:i + depth]] > 1 for i in range(n)])
        assert (D.repeated_strings(data, valid, depth) == want).all()


def test_suffix_array_and_common_prefixes():
    data = np.frombuffer(b"mississippi$mississippi$abracadabra" * 3, np.uint8)
    order, rank = D.suffix_array(data, 16)
    heads = [bytes(data[i:i + 16]).ljust(16, b"\0") for i in order]
    assert heads == sorted(heads)
    prefix = D.common_prefixes(data, order, rank, 16)
    for k in range(1, len(order)):
        a, b = heads[k - 1], heads[k]
        assert prefix[k] == next((i for i in range(16) if a[i] != b[i]), 16)


def test_every_string_has_one_piece_and_equal_strings_equal_anchors():
    data = np.frombuffer((texts()[0] * 3).encode(), np.uint8)
    anchors, first, size = D.pieces(data, 200, 32)
    assert first[0] == 0 and (first[1:] == first[:-1] + size[:-1]).all() and first[-1] + size[-1] == len(data) - 199
    found, places = D.anchor_places(data, 200, 32)
    assert set(found.tolist()) == set(anchors.tolist()) and places.min() >= 1


@pytest.mark.parametrize("spread", [4000, 2])
def test_dedup_equals_brute_force(spark, spread):
    """``spread`` 2 sends most anchors over several shards, so that the merge decides."""
    df = awkward(spark)
    rows = df.collect()
    want = sorted((str(r.doc_id), *x) for r, x in zip(rows, brute([r.text for r in rows], 200)))
    got = D.dedup(df, anchor_pieces=spread).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_removed_keeps_rows_and_whole_characters(spark):
    df = documents(spark, rows=["é" * 150 + "1", "xé" + "é" * 150 + "2", None, "", "short"])
    got = D.removed(df)
    assert got.columns == df.columns
    out = {r.doc_id: r.text for r in got.collect()}
    assert len(out) == 5 and out[14] is None and out[21] == "" and out[28] == "short"
    assert set(out[0] + out[7]) <= set("éx12")


def test_empty_table(spark):
    assert D.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
