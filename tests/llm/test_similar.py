"""N-gram Jaccard join, paragraph dedup and components against brute force."""

import random

import numpy as np
import pytest

from campuswatt.llm import jaccard_join as J, paragraph_dedup as P
from campuswatt.llm.common import components
from fixtures import SCHEMA, Sets, awkward, documents, linked, sentence, shingles, texts


def brute(rows):
    sets = [shingles(r.text) for r in rows]
    real = [i for i, s in enumerate(sets) if s]
    ids = [rows[i].doc_id if rows[i].doc_id is not None else 10 ** 9 for i in real]
    out = {i: c for i, c in zip(real, linked([sets[i] for i in real], ids))}
    return sorted((str(r.doc_id), len(sets[i]), str(out.get(i, r.doc_id)).replace(str(10 ** 9), "None")) for i, r in enumerate(rows))


def test_links_equal_brute_force(spark):
    df = awkward(spark)
    got = J.links(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(df.collect())


def test_links_of_a_large_group_of_near_copies(spark):
    """Variants of one text, some on either side of the threshold, and chains of variants."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(80)] = f"v{rng.randrange(10 ** 6)}"
        rows.append(" ".join(words))
    for _ in range(40):
        words = rows[-1].split(" ")
        words[rng.randrange(80)] = f"c{rng.randrange(10 ** 6)}"
        rows.append(" ".join(words))
    df = documents(spark, rows=rows)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.links(df).collect()) == brute(df.collect())


def test_hot_ngrams_take_another_way_to_the_same_result(spark):
    df = documents(spark)
    rows = df.select("text")
    sets = [J.document_sets(np.array([0, len(t.encode())]), np.frombuffer(t.encode(), np.uint8), 5) for t in texts()[30:33]]
    hot = np.unique(np.concatenate([next(iter(s)) for s in sets]))[:40]
    plain = J._requests(rows, 5, 4, np.empty(0, np.uint64)).groupBy("bucket").applyInArrow(lambda t: J._repeated(t, 2), J._REPLY)
    other = (J._requests(rows, 5, 4, hot).groupBy("bucket").applyInArrow(lambda t: J._repeated(t, 2), J._REPLY)
             .unionByName(J._hot_replies(rows, 5, hot, 2, 4)))
    sets = [{(bytes(r.key), r.n, frozenset(np.frombuffer(r.grams, "<u8").tolist())) for r in x.groupBy("home").applyInArrow(
        lambda t: J._candidates(t, 80, 100), "key binary, n long, grams binary, ranges array<int>").collect()} for x in (plain, other)]
    assert sets[0] == sets[1] and sets[0]


@pytest.mark.parametrize("rows", [[], [None], ["", " "]])
def test_links_of_nothing(spark, rows):
    got = J.links(documents(spark, rows=rows) if rows else spark.createDataFrame([], SCHEMA)).collect()
    assert [(r.n_shingles, r.component_id == r.doc_id) for r in got] == [(0, True)] * len(rows)


def test_one_each_keeps_one_row_of_each_component(spark):
    df = awkward(spark)
    kept = J.one_each(df)
    assert kept.columns == df.columns
    rows = brute(df.collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({c for d, _, c in rows if d == c} | {"None"})


def test_one_each_with_null_and_repeated_ids(spark):
    """Near copies that share the smallest id, or have none, leave one row; columns may have names used inside."""
    rng = random.Random(8)
    base, other = sentence(rng, 100), sentence(rng, 100)
    texts = [base, base + " more", base + " and more", other, other + " more", other]
    ids = [3, 3, 9, None, None, None]
    rows = [(i, t, f"x{k}", 1, 2) for k, (i, t) in enumerate(zip(ids, texts))] + [(5, None, "y", 1, 2), (6, "", "z", 1, 2), (6, "", "zz", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string, _root int, _nth int")
    kept = J.one_each(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((r.doc_id for r in got), key=str) == [3, 5, 6, None]
    assert J.one_each(df).orderBy("doc_id", "text").select("doc_id", "text").collect() == kept.orderBy("doc_id", "text").select("doc_id", "text").collect()


def test_components(spark):
    rng, groups = random.Random(2), Sets()
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(300, 300 + k) for k in range(1, 50)]
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    got = components(spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in edges], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: groups.find(x) for x in groups.up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- paragraphs --------------------------------------------------------------------

def paragraphs(rows, least=20):
    out = []
    for r in rows:
        for k, line in enumerate([x for x in (r.text or "").split("\n") if x]):
            s = line.split()
            if len(s) >= least:
                out.append((r.doc_id, k, len(s), shingles(line)))
    return out


def test_bands_reach_the_recall():
    bands, rows = P.tune(0.8, 0.998, 64)
    assert bands * rows <= 64 and 1 - (1 - 0.8 ** rows) ** bands >= 0.998
    assert P.tune(0.5, 0.9999, 8) == (8, 1)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [t for t in texts(4) if t is None or len(t) < 50_000]
    line = sentence(rng, 90)
    rows += [sentence(rng, 30) + "\n" + line.replace(line.split(" ")[k], "swapped") + "\n" + sentence(rng, 30) for k in range(0, 60, 7)]
    df = documents(spark, rows=rows)
    found = [p for p in paragraphs(df.collect())]
    ids = [(d, k) for d, k, _, _ in found]
    firsts = linked([s for *_, s in found], ids)
    many = {f for f in firsts if firsts.count(f) > 1}
    want = sorted((d, k, n, f[0], f[1], (d, k) != f) for (d, k, n, _), f in zip(found, firsts) if f in many)
    got = P.clusters(df).collect()
    assert sorted((r.doc_id, r.paragraph, r.n_words, r.first_doc_id, r.first_paragraph, r.removed) for r in got) == want
    by_id = {r.doc_id: r.text for r in df.collect()}
    for r in got:
        line = [x for x in by_id[r.doc_id].split("\n") if x][r.paragraph]
        assert by_id[r.doc_id].encode()[r.start:r.start + r.length].decode() == line


def test_clusters_of_awkward_tables(spark):
    assert P.clusters(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.clusters(documents(spark, rows=[None, "", "short"])).count() == 0
    assert P.clusters(awkward(spark)).filter("doc_id = 7").count() == 2 * len(paragraphs([r for r in awkward(spark).collect() if r.doc_id == 7])) // 2


def test_repeats_find_passages_inside_longer_lines(spark):
    """Passages of 60 words in the middle of lines, and over other line ends; most windows of a passage are found."""
    rng = random.Random(12)
    rows, passages = [], []
    for k in range(40):
        passage = sentence(rng, 60)
        passages.append(passage)
        for part in range(2):
            inside = passage.replace(" ", "\n", 1 + 4 * part) if k % 2 else passage
            rows.append(sentence(rng, 300) + " " + inside + " " + sentence(rng, 200 + 100 * part))
    df = documents(spark, rows=rows)
    ids = [r.doc_id for r in df.orderBy("doc_id").collect()]
    got = P.repeats(df).collect()
    firsts = {}
    by_id = {r.doc_id: r.text for r in df.collect()}
    for r in got:
        part = " ".join(by_id[r.doc_id].encode()[r.start:r.start + r.length].decode().split())
        assert len(part.split()) == r.n_words
        firsts.setdefault(part.lower(), []).append(r)
    assert P.clusters(df).count() == 0
    for part, occurrences in firsts.items():
        assert len(occurrences) > 1 and sum(not r.removed for r in occurrences) == 1
    found = sum(any(part in p.lower() and len(part.split()) > 6 for part in firsts) for p in passages)
    assert found >= 39 and len(ids) == 80


def test_windows_of_awkward_tables(spark):
    assert P.repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.repeats(documents(spark, rows=[None, "", "short"])).count() == 0
    df = documents(spark, rows=["same " * 40, "a b c d e f g"])
    assert sorted((r.start, r.n_words, r.removed) for r in P.repeats(df).collect()) == [(0, 16, False), (80, 16, True)]
