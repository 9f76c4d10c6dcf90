"""Packing, mixing, quality rules and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from campuswatt.llm import cube_mixing as C, packing as P, quality_cascade as Q, suffix_dedup
from fixtures import SCHEMA, awkward, documents, linked, shingles, texts, words


# --- packing -------------------------------------------------------------------------

ODD = ["", None, "don't WE'RE", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "x.y,z... hi!!!! ok?!. a1b2 12,000.50 é. É! ß;",
       "中文。字, 😀. 😀,. a😀. _. a_. -.", "a\x0bb\x0cc\x1cd\x85e", "l'. l'! 'd. x'D. ΣΑΣ. İ. ǅ.", "a " * 3000]


def test_ids_equal_the_tokenizer():
    import pyarrow as pa
    from campuswatt.llm import text as X
    plain, table = Tokenizer.from_file(P.tokenizer_path()), P.WordIds(P.tokenizer_path())
    for rows in (ODD, texts()[:60], ODD[::-1]):
        for first, offsets, data in X.chunks(pa.array(rows, pa.string()), limit=5000):
            flat, at = table.ids(data, offsets)
            for i in range(len(offsets) - 1):
                assert flat[at[i]:at[i + 1]].tolist() == plain.encode(rows[first + i] or "", add_special_tokens=False).ids


def test_tightest_window_is_the_tightest():
    rng, tree, rooms = np.random.default_rng(3), P.OpenWindows(64), Counter()
    for step in range(3000):
        if rng.random() < 0.5:
            room = int(rng.integers(1, 65))
            tree.add(room, step)
            rooms[room] += 1
        need = int(rng.integers(1, 65))
        want = min((r for r, n in rooms.items() if n and r >= need), default=None)
        got = tree.tightest(need)
        assert (got and got[0]) == want
        if got:
            rooms[want] -= 1


@pytest.mark.parametrize("shard_pieces", [50_000, 10])
def test_packing_is_an_exact_round_trip(spark, shard_pieces):
    df = documents(spark, rows=texts() + ODD)
    got = P.pack(df, shard_pieces=shard_pieces).toPandas().sort_values(["sequence_id", "offset"])
    fill = got.groupby("sequence_id").length
    assert ((fill.cumsum() - got.length) == got.offset).all() and fill.sum().max() <= 2048
    plain = Tokenizer.from_file(P.tokenizer_path())
    assert got.doc_id.nunique() == df.count()
    for row in df.collect():
        ids = np.array(plain.encode(row.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        mine = got[got.doc_id == row.doc_id].sort_values("start")
        assert mine.start.tolist() == [0, *(mine.start + mine.length).tolist()[:-1]]
        assert (mine.doc_tokens == len(ids)).all() and mine.length.sum() == len(ids)
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(mine.start, mine.length)]


def test_packing_wastes_little():
    rng = np.random.default_rng(1)
    lengths = sorted(rng.integers(1, 2048, 20_000).tolist(), reverse=True)
    number, offset = P.best_fit(lengths)
    assert sum(lengths) / ((max(number) + 1) * 2048) > 0.99


def test_packing_of_awkward_tables(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    df = awkward(spark)
    assert P.pack(df).filter("start = 0").count() == df.count()


# --- mixing --------------------------------------------------------------------------

def waterfill(sizes, total, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(sum(w[s] for s in free), 1e-9)
        above = [s for s in free if w[s] * level >= 2 * sizes[s]]
        if not above:
            return {s: fixed.get(s, w[s] * level) for s in names}
        fixed.update({s: 2 * sizes[s] for s in above})


def test_mix_meets_its_targets_and_reruns_agree(spark):
    df = awkward(spark)
    rows = df.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    want = waterfill(sizes, 1.5 * sum(sizes.values()))
    got = C.mix(df, block=16).join(df.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    taken, again = Counter(), C.mix(df, block=16).collect()
    for r in got:
        source = r.source if r.doc_id is not None else None
        taken[source] += r.taken
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, r.size, 2 * r.size)
    for s in sizes:
        if s != rows[[len(words(r.text)) for r in rows].index(max(len(words(r.text)) for r in rows))].source:
            assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 60
    assert sorted(map(str, again)) == sorted(str(r) for r in C.mix(df, block=16).collect())


def test_flight_keeps_sums_and_chances():
    rng = np.random.default_rng(4)
    sizes, chances = rng.integers(1, 2000, 300), np.full(300, 0.37)
    hits = np.zeros(300)
    for k in range(200):
        p = C.flight(sizes, chances, np.random.default_rng(k))
        assert abs(p @ sizes - chances @ sizes) < 1e-6 * sizes.sum() and abs(p.sum() - chances.sum()) < 1e-6
        assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
        hits += p
    assert abs(hits / 200 - 0.37).max() < 0.2
    done = C.decide(sizes, chances, np.random.default_rng(9), True)
    assert set(done.tolist()) <= {0.0, 1.0} and abs(done @ sizes - chances @ sizes) < sizes.max() / 20


def test_mixed_rows_follow_the_copies(spark):
    df = awkward(spark)
    out = C.mixed(df)
    assert out.columns == df.columns
    want = Counter()
    for r in C.copies(df).collect():
        want[str(r.doc_id)] += r.copies
    assert Counter(str(r.doc_id) for r in out.collect()) == +want
    assert C.mixed(spark.createDataFrame([], SCHEMA)).count() == 0


# --- quality rules --------------------------------------------------------------------

def judge(text):
    w, t = words(text), text or ""
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {i + k for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


JUNK = ["WORDS!! IN!! CAPITALS!! " * 6 + "THAT!! SHOUT!! AT!! YOU!!", "a | b | c | d | e | f | g | h | i | j | k | l | m", "and " * 40]


def test_assess_equals_brute_force(spark):
    df = documents(spark, rows=texts() + JUNK + ODD)
    text = {r.doc_id: r.text for r in df.collect()}
    for r in Q.assess(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == judge(text[r.doc_id])
        if r.base_failed:
            assert not r.kept


def test_order_of_rules_changes_no_verdict(spark):
    import pyarrow as pa
    from campuswatt.llm import text as X
    (_, offsets, data), = X.chunks(pa.array(texts() + JUNK, pa.string()), limit=1 << 30)
    block, names = Q.Block(offsets, data), list(Q.RULES)
    want = [i for i in range(len(block)) if not any(rule(block)[i] for rule in Q.RULES.values())]
    for k in range(len(names)):
        assert Q.passes(Q.Block(offsets, data), Q.RULES, names[k:] + names[:k]).tolist() == want
    assert set(range(30)) <= set(want) and not set(want) & set(range(len(block) - 3, len(block)))


def test_cheap_rejecting_rules_come_first():
    rules = {"a": Q.Rule(None, "n_lines"), "b": Q.Rule(None, "n_words"), "c": Q.Rule(None, "n_upper"), "d": Q.Rule(None, "n_lines", "n_upper")}
    seconds = {"n_lines": 1.0, "n_words": 0.1, "n_upper": 0.1}
    assert Q.in_order(rules, (seconds, {"a": 100, "b": 100, "c": 0, "d": 0})) == ["b", "a", "c", "d"]
    # a rule whose measures are taken already costs nothing, so it goes before a costly one
    assert Q.in_order(rules, (seconds, {"a": 100, "b": 1, "c": 30, "d": 1})) == ["c", "a", "d", "b"]


def test_a_rejected_text_is_measured_no_further():
    import pyarrow as pa
    from campuswatt.llm import text as X
    (_, offsets, data), = X.chunks(pa.array(["too few words", "x " * 100, "some words that are all of them different and enough"], pa.string()))
    block, seen = Q.Block(offsets, data), []
    rules = {"first": Q.RULES["few_words"], "second": Q.Rule(lambda r, n: seen.append(len(r)) or r > 0, "n_repeat_words", "n_words")}
    assert Q.passes(block, rules, ["first", "second"]).tolist() == [2]
    assert seen == [2] and block._known["n_repeat_words"].tolist() == [False, True, True]
    assert block.measure("n_repeat_words").tolist() == [0, 100, 0] and block._known["n_repeat_words"].all()


def test_keep_keeps_columns_and_awkward_tables(spark):
    df = awkward(spark)
    kept = Q.keep(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    ids = Counter(str(r.doc_id) for r in Q.assess(df).filter("kept").collect())
    assert Counter(str(r.doc_id) for r in kept.collect()) == ids
    assert Q.keep(spark.createDataFrame([], SCHEMA)).count() == 0 and Q.assess(spark.createDataFrame([], SCHEMA)).count() == 0


# --- pipeline -------------------------------------------------------------------------

def test_stages_on_their_own_input(spark, tmp_path):
    docs = documents(spark, rows=texts() + JUNK)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "passages", "mix", "pack"]

    good = stages["quality"](spark, docs, str(tmp_path))
    rows = good.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in Q.assess(docs).filter("kept").collect()}
    one = stages["near_copies"](spark, good, str(tmp_path))
    roots = linked([shingles(r.text) for r in rows], [r.doc_id for r in rows])
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(roots))
    cut = stages["passages"](spark, one, str(tmp_path))
    assert cut.count() == one.count() and cut.filter("n_chars <> length(text)").count() == 0
    left = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.dedup(one).collect()}
    assert all(0 <= left[r.doc_id] - len(r.text.encode()) < 8 for r in cut.collect())
    mixed = stages["mix"](spark, cut, str(tmp_path))
    assert mixed.columns == docs.columns
    packed = stages["pack"](spark, mixed, str(tmp_path))
    assert packed.filter("start = 0").count() == mixed.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()


CLASHING = "doc_id long, text string, source string, _tag string, _row string, _nth int, _key string, _kept string, _times int, _copies int, bucket int, key int, gram int"


def test_stages_on_empty_tables_and_clashing_columns(spark):
    """No rows give no rows; columns named like those inside come out as they went in."""
    stages = corpus_pipeline.STAGES
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "a", "b", i, "c", "d", i, i, 1, 2, 3) for i, t in enumerate(texts()[:45])]
    for values in ([], rows):
        docs = spark.createDataFrame(values, CLASHING)
        for name, stage in stages[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            got = out.select("doc_id", *docs.columns[3:]).distinct().collect()
            want = {(r[0], *r[3:]) for r in values}
            assert {tuple(r) for r in got} <= want and bool(got) == bool(values)
        assert (stages[-1][1](spark, docs, "").count() > 0) == bool(values)
