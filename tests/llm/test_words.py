"""Clusters, byte pairs and spelling variants against brute force and the tokenizers library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campuswatt.llm import byte_pairs as B, queries, shallot as S, variants as V
from fixtures import awkward

DATA = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


# --- clusters ---------------------------------------------------------------------------

def in_order(rows, dim, k=8, rounds=10, seed=3):
    """Lloyd's rounds in Python integers."""
    kept = [(i, [math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024 for x in v]) for i, v in rows
            if v is not None and len(v) == dim and None not in v and all(math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((p - q) ** 2 for p, q in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, q) in zip(kept, at) if q == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at, most = assign(), (1 << 63) - 1
    fits = lambda ds: sum(ds) if max(ds) <= most and sum(ds) <= most else None
    inertia = {j: fits([d for d, q in at if q == j]) for j in {q for _, q in at}}
    return ordered((i, q, d if d <= most else None, inertia[q], fits([d for d, _ in at]),
                    hashlib.sha256(",".join(map(str, centres[q])).encode()).hexdigest()) for (i, _), (d, q) in zip(kept, at))


def clustered(spark, rows, **settings):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, nearest string")
    return ordered(S.assignments(table.repartition(3), **settings).collect())


def test_clusters_equal_rounds_in_integers(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=6)).tolist()) for i in range(300)]
    assert clustered(spark, rows, components=6) == in_order(rows, 6)


def test_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)]) for i in range(150)]
    rows += rows[:20] + [(None, [1.0, 0.0, 0.0]), (None, [-1.0, 0.0, 0.0])]
    assert clustered(spark, rows, components=3) == in_order(rows, 3)
    same = [(i, [0.5, 0.5]) for i in range(30)]
    assert clustered(spark, same, components=2) == in_order(same, 2)


def test_vectors_that_take_no_part_and_very_long_ones(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [float("nan")] * 4), (105, [None, 1.0, 1.0, 1.0]), (106, [float("inf")] * 4)]
    assert clustered(spark, rows, components=4) == in_order(rows, 4)
    rows += [(200, [1e12] * 4), (201, [-1e300, 0.0, 0.0, 1.0]), (202, [1.7e308] * 4), (203, [70000.0] * 4)]
    assert clustered(spark, rows, components=4) == in_order(rows, 4)


def test_few_and_no_vectors(spark):
    assert clustered(spark, [], components=2) == []
    rows = [(7, [1.0, 2.0]), (8, [3.0, 4.0])]
    assert clustered(spark, rows, components=2) == in_order(rows, 2)
    assert clustered(spark, rows[:1], components=2) == in_order(rows[:1], 2)


def test_bounds_spare_distances():
    """Once the centroids rest nearly, most vectors are not measured again, and the result is that of a full scan."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (8, 16))
    x = (centres[rng.integers(0, 8, 4000)] + rng.integers(-60, 60, (4000, 16))).astype("<i2")
    rows = [tuple(map(int, c)) for c in centres]
    old = S.Centroids(rows)
    best = old.scan(x)
    new = S.Centroids([tuple(v + 1 for v in r) for r in rows], rows)
    measured, real = [], S.Centroids.distance
    new.distance = lambda v, at: measured.append(len(v)) or real(new, v, at)
    nearest, *_ = new.shallot(x, best[0], best[2], np.sqrt(best[1]), np.sqrt(best[3]))
    full = np.array([real(new, x, c) for c in range(8)]).argmin(axis=0)
    assert (nearest == full).all() and sum(measured) < 4000


def test_cluster_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op11_shallot_clusters"](spark, DATA)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ordered(got.collect()) == in_order(rows, 64)


# --- byte pairs ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.vocabulary_path())


@pytest.fixture(scope="module")
def own():
    return B.BytePairs(B.vocabulary_path())


PIECES = ["a", "b", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "<|", "é", "日", "😀", "́", "1", "\x00", "​", "\xa0", "　", "the", "AB", "²"]


def test_encoding_equals_the_library(own, library):
    rng = random.Random(0)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        assert own.decode(np.array(want, dtype=np.int64), np.array([len(want)]))[0] == library.decode(want, skip_special_tokens=False)


def test_decoding_of_any_ids_equals_the_library(own, library):
    rng = random.Random(1)
    lists = [[rng.randrange(50_400) for _ in range(rng.randrange(30))] for _ in range(800)]
    flat = np.array([i for ids in lists for i in ids], dtype=np.int64)
    assert own.decode(flat, np.array([len(x) for x in lists])) == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_one_long_piece(own, library):
    text = "ab" * 30_000 + "x" * 20_001
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_a_small_cache_changes_nothing(own, monkeypatch):
    texts = [" ".join(random.Random(i).choices(["alpha", "beta", "gamma", "deltas", "epsilon"], k=50)) for i in range(20)]
    want = [own.encode(t) for t in texts]
    monkeypatch.setattr(B, "KNOWN_PIECES", 2)
    fresh = B.BytePairs(B.vocabulary_path())
    assert [fresh.encode(t) for t in texts] == want


def test_columns_and_awkward_rows(spark, library):
    docs = awkward(spark).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit(1))
    coded = B.encode(docs)
    assert coded.columns == [c for c in docs.columns if c != "ids"] + ["ids"]
    for r in B.decode(coded).collect():
        text = r.text or ""
        assert r.ids == library.encode(text, add_special_tokens=False).ids and r.decoded == text
    lists = spark.createDataFrame([(None,), ([],), ([None, 64, -5, 10**6],)], "ids array<int>")
    assert [r.decoded for r in B.decode(lists).collect()] == ["", "", "a"]


def test_only_plain_vocabularies(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"vocab": {}, "merges": []}, "pre_tokenizer": {"type": "Whitespace"}}')
    with pytest.raises(ValueError, match="byte-level"):
        B.BytePairs(str(path))


def test_byte_pairs_query(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op12_byte_pairs"](spark, DATA).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256, got[d.doc_id].decoded_sha256) == want


# --- spelling variants ----------------------------------------------------------------------

LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def spelled(docs, letters=7, occurrences=2, times=10):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    n = {w: c for w, c in n.items() if len(w) >= letters and c >= occurrences}
    near = {w: set() for w in n}
    holders = {}
    for w in n:
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            holders.setdefault(k, []).append(w)
    for group in holders.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return ordered((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def variants(spark, docs, **settings):
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, word string")
    return ordered(V.variants(table.repartition(3), **settings).collect())


def dictionary(seed):
    rng = random.Random(seed)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(40)]

    def slip(w):
        i, kind = rng.randrange(len(w)), rng.randrange(3)
        return w[:i] + ["", rng.choice("abcé÷"), rng.choice("abcé") + w[i]][kind] + w[i + 1:]

    docs = []
    for d in range(250):
        words = [base[min(int(rng.expovariate(0.15)), 39)] for _ in range(40)]
        words = [slip(w) if rng.random() < 0.2 else w.upper() if rng.random() < 0.1 else w for w in words]
        docs.append((d, rng.choice([" ", ", ", "_", "1"]).join(words)))
    return docs


@pytest.mark.parametrize("part", [2000, 5])
def test_variants_equal_brute_force(spark, part):
    docs = dictionary(part)
    got = variants(spark, docs, part=part)
    assert got == spelled(docs) and sum(r[1] is not None for r in got) > 50


def test_variants_of_awkward_texts(spark):
    long = "x" * 3000
    docs = [(i, f"{long}y z{long} {long} abcdefg abcdefgh bcdefgh Abcdefgh éabcdefg abcdefé") for i in range(3)]
    docs += [(7, "aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaaa " * 3)] * 2 + [(None, "abcdefgh abcdefgi"), (9, None), (10, ""), (None, None)]
    assert variants(spark, docs) == spelled(docs)


def test_a_chain_of_forms_ends_at_its_root(spark):
    docs = [(1000 + i, text) for text, times in (("abcdefghi", 400), ("abcdefgh", 30), ("abcdefg", 3)) for i in range(times)]
    got = variants(spark, docs, odd=1 << 40)
    assert [(r[0], r[1], r[2]) for r in got] == [("abcdefg", "abcdefgh", "abcdefghi"), ("abcdefgh", "abcdefghi", "abcdefghi"), ("abcdefghi", None, "abcdefghi")]


def test_no_words(spark):
    assert variants(spark, []) == []
    assert variants(spark, [(1, "short words only"), (2, None)]) == []


def test_variants_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_spelling_variants"](spark, DATA)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert ordered(got.collect()) == spelled(docs)


def test_short_pieces_merge_like_long_ones(monkeypatch):
    """The list of ranks of a short piece and the queue of a long one give the same ids; known ids are tuples."""
    tokenizer = B.BytePairs(B.vocabulary_path())
    rnd = random.Random(5)
    pieces = ["", "a", "aaaa", "aaaaa", " the", " théâtre", "!!!!!!!", *("".join(rnd.choices(" etaoinsé!", k=rnd.randint(1, 40))) for _ in range(300))]
    symbols = [[tokenizer.first[b] for b in p.encode()] for p in pieces]
    short = [tokenizer._short(list(s)) for s in symbols]
    monkeypatch.setattr(B, "SHORT", 0)
    assert short == [tokenizer.merged(s) for s in symbols]
    tokenizer.encode("one two")
    assert all(type(ids) is tuple for ids in tokenizer._known.values())


def test_trie_nodes_are_counted_without_a_sort(spark):
    """Letters are code points: text would have the least and the greatest letter of a node found by sorting."""
    words = spark.createDataFrame([(">énergie",), (">énergies",)], "word string")
    nodes = V._prefixes(words, 2).groupBy("node").agg(F.min("next").alias("lo"), F.max("next").alias("hi"))
    assert "SortAggregate" not in nodes._jdf.queryExecution().executedPlan().toString()
    ends = [r for r in nodes.collect() if r.lo == 0]
    assert sorted(r.hi for r in ends) == [0, ord("s")]


def test_the_trie_has_a_row_an_edge_not_a_row_a_prefix(spark):
    """Long words that share nothing behind their first letters are few edges each, however long they are."""
    words = spark.createDataFrame([(f">{a}{b}{'x' * 60}{a}",) for a in "abcd" for b in "efgh"], "word string")
    assert V._prefixes(words, 2).count() <= 4 * 16


@pytest.mark.parametrize("part", [1, 3, 2000])
def test_trie_edges_equal_prefixes(spark, part):
    """Every edge's numbers against the words below its child; small parts cut the words that begin alike."""
    rng = random.Random(part)
    marked = sorted({"><"[i % 2] + "".join(rng.choices("abé", k=rng.randint(4, 9))) for i in range(600)})
    edges, starts, ends = V.trie(spark.createDataFrame([(w,) for w in marked], "word string").repartition(3), part)
    prefix, below, names = {}, {}, {}
    for w in marked:
        node = 0
        for i, c in enumerate(w):
            node = (node * V._BASE + ord(c) + 1) % V._PRIME
            prefix[node] = w[:i + 1]
            below.setdefault(w[:i + 1], []).append(w)
        names[w] = node
    assert sorted((r.near, r.node) for r in ends.collect()) == sorted(names.items())
    level, parts_of, salts = {}, {}, {}
    rows = edges.collect()
    for r in rows:
        p, held = prefix[r.child], below[prefix[r.child]]
        assert prefix[r.parent] + r.label == p and r.letter == r.label[0] and r.ends == (p in names) and r.alone == (len(held) == 1)
        assert r.parts == -(-len(held) // part) and set(r.following) == {w[len(p)] for w in held if len(w) > len(p)}
        assert r.sizes == sum(1 << n for n in {len(w) for w in held})
        salts.setdefault((r.parent, r.child), []).append(r.salt)
        assert level.setdefault(r.parent, r.level) == r.level
    assert all(sorted(s) == list(range(-(-len(below[prefix[up]]) // part))) for (up, _), s in salts.items())
    assert all(level[down] == level[up] + 1 for up, down in salts if down in level)
    halves = starts.collect()
    assert sorted(r.word for r in halves) == marked
    for r in halves:
        letters = len(r.word) - 1
        assert r.pos == 1 + (letters // 2 if r.word[0] == ">" else letters - letters // 2) and prefix[r.node] == r.word[:r.pos]
        assert r.parts == -(-len(below[r.word[:r.pos]]) // part) and level.get(r.node, r.level) == r.level
