"""Neighbours, classifier, license scan and WARC archives."""

import gzip
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from campuswatt.llm import hnsw as H, license_scan as L, quality_classifier as C, queries, warc as W
from fixtures import LOWER, SCHEMA, awkward, documents, sentence, texts

DATA = "/root/testdata/sf0.001"


# --- neighbours ------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, key string")


def exact(rows, nearest=20, every=20):
    ok = [(i, np.array(v, dtype=float)) for i, v, *_ in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-float(u @ v), i) for i, u in ok if i != q and len(u) == len(v))[:nearest]
            out[q] = [(i, -s) for s, i in scored]
    return out


def test_neighbours_of_any_lengths_and_awkward_rows(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 24)) * 3
    rows = [(i, (centres[i % 12] * rng.uniform(0.2, 2) + rng.normal(size=24)).astype(np.float32).tolist(), 1, "x") for i in range(900)]
    same = rows[5][1]
    rows += [(i, same, 1, "x") for i in range(2000, 2400)]
    rows += [(4000, None, 1, ""), (4020, [0.0] * 24, 1, ""), (4040, [float("nan")] * 24, 1, ""), (4060, [None, 1.0], 1, ""),
             (4080, [float("inf")] * 24, 1, ""), (None, same, 1, ""), (4100, [], 1, ""), (6000, [1.0, 2.0], 1, ""), (6001, [0.5, 0.1], 1, "")]
    want = exact(rows)
    got = {}
    for r in H.neighbours(vectors(spark, rows).repartition(4)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = total = 0
    for q, found in got.items():
        assert [k for k, *_ in found] == list(range(1, len(want[q]) + 1))
        assert [s for *_, s in found] == sorted((s for *_, s in found), reverse=True)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
        total += len(want[q])
    assert hits / total > 0.97
    assert [i for _, i, _ in got[2000]] == [i for i, _ in want[2000]] and [i for _, i, _ in got[6000]] == [6001]


def test_one_very_long_vector_leaves_the_others_their_neighbours(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(3000, 48))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[7] *= 5000
    rows = [(i, p.tolist(), 1, "x") for i, p in enumerate(points.astype(np.float32))]
    want = exact(rows)
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in H.neighbours(vectors(spark, rows)).collect())
    assert hits / sum(map(len, want.values())) > 0.97


def test_graph_round_trip():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(600, 16)).astype(np.float32)
    graph = H.Graph(points)
    again = H.Graph.unpack(points, *graph.pack())
    for q in points[:20]:
        assert graph.search(q, 60).tolist() == again.search(q, 60).tolist()


def test_several_shards_and_blocks_agree(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), 0, "") for i in range(400)]
    base = H.usable(vectors(spark, rows))
    found = H.search(H.index(base, shard_vectors=60), base.select("key", "vec", "dim"), 5, query_block=90)
    assert found.groupBy("query").count().filter("count < 5").count() == 0
    assert found.count() == 400 * 5 * 7


def test_no_vectors(spark):
    assert H.neighbours(vectors(spark, [])).count() == 0
    assert H.neighbours(vectors(spark, [(20, [1.0], 0, "")])).count() == 0


# --- classifier ------------------------------------------------------------------------

def test_classifier_learns_what_it_has_not_seen(spark):
    rng = random.Random(3)
    rows = [sentence(rng, 60) if k % 2 else " ".join(["junk###"] * 3 + [f"q{rng.randrange(900)}$$$" for _ in range(40)]) for k in range(400)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "", "", "") for i, t in enumerate(rows)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(7, 1, 0), (None, 1, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    got = C.score(df, C.fit(df, labels)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == r.doc_id % 2 for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_classifier_of_awkward_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = awkward(spark)
    got = C.score(df, C.fit(df, labels)).collect()
    assert len(got) == df.count() and {r.score for r in got} == {0.5}
    assert C.score(spark.createDataFrame([], SCHEMA), C.Model(np.zeros(8, np.float32), 0.0)).count() == 0


# --- license scan ----------------------------------------------------------------------

def test_scan_equals_sql(spark, tmp_path):
    rows = texts() + [
        "All Rights Reserved.", "CC-BY\nall rights reserved all rights reserved", "cc\nby", "ccby cc by", "General Public LICENSE x",
        "text\nLicensed under the Apache License, Version 2.0.\nmore", "licensed under apache license version 2", "the the the all all rights",
        "Permission is granted, free of charge, to any person obtaining a copy of this software and associated files", "ÀLL rights reserved", "all rights reservedé"]
    df = awkward(spark).unionByName(spark.createDataFrame([(5000 + i, t, "en", "s", 1, "", "", "") for i, t in enumerate(rows)], SCHEMA))
    df.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = L.scan(spark.read.parquet(str(tmp_path / "documents.parquet")))
    want = con.execute(queries.OP6_SQL).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*[d[0] for d in con.description]).collect()))) == sorted(map(str, want))
    assert got.filter("labels <> base_labels").count() > 2
    assert L.scan(df).count() == df.count()
    assert L.scan(spark.createDataFrame([], SCHEMA)).count() == 0


WRAPPED = {
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation\n"
                  "files (the \"Software\"), to deal in the Software without restriction",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\nconditions\nare met:",
    "gpl-program-notice": "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
                          "    the Free Software Foundation, either version 3",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla\n * Public License, v. 2.0. If a copy",
    "apache-notice": "Licensed under the Apache\nLicense, Version 2.0",
    "cc0-notice": "To the extent possible under law,\nthe author has waived all copyright\nand related or neighboring rights to this work.",
    "mit-line": "Released under the MIT License.",
    "cc-notice": "licensed under\nCC BY 4.0", "gpl-notice": "This work is licensed under the GNU\nGeneral Public License, version 3.", "reserved-notice": "All rights\nreserved",
}


def best_blocks(text):
    """Brute force over every run of words."""
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    out = {}
    for label, template in L.TEMPLATES.items():
        ws = set(template.split(" "))
        most = max((len(ws & set(words[i:i + 2 * len(ws)])) for i in range(len(words))), default=0)
        if 100 * most >= 80 * len(ws):
            out[label] = most / len(ws)
    return out


def test_wrapped_notices_are_found(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 60) + "\n" + t + "\n" + sentence(rng, 60)) for i, t in enumerate(WRAPPED.values())]
    every = list(L.TEMPLATES.values())
    for i in range(300):       # words of notices, whole and torn apart
        parts = []
        for _ in range(rng.randrange(1, 5)):
            words = rng.choice(every).split(" ")
            parts += [w for w in words if rng.random() < 0.9] if rng.random() < 0.6 else rng.sample(words, len(words))
            parts += sentence(rng, rng.choice([0, 0, 3, 30])).split()
        rows.append((100 + i, rng.choice([" ", "\n", ", "]).join(parts)))
    df = spark.createDataFrame([(i, t, "", "", 1, "", "", "") for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in L.scan(df).collect()}
    for i, text in rows:
        want = best_blocks(text)
        assert set(got[i].labels.split(",")) - {""} == set(want) | (set(got[i].base_labels.split(",")) - {""})
        assert got[i].score == (1.0 if got[i].n_base else max(want.values(), default=0.0))
    for i, label in enumerate(WRAPPED):
        assert label in got[i].labels.split(",")


def test_scan_runs_no_python(spark):
    plan = L.scan(documents(spark, rows=["all rights reserved"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- WARC ------------------------------------------------------------------------------

HTML = ["<p>one</p>", "x" * 100, "x" * 100, "y" * 99, "y" * 99, "<html>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "z" * 90,
        None, "", "x" * 100, "line\n" * 60, "\r\n\r\n" * 40, "line\n" * 60]


def pages(spark, html=HTML):
    return spark.createDataFrame([(10 - i, f"http://h/{i} \n a", t, "d", 1) for i, t in enumerate(html)], "page_id long, url string, html string, digest string, bytes int")


def test_round_trip_equals_sql(spark, tmp_path):
    pages(spark).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(queries.OP9_SQL).fetchall()
    got = W.round_trip(spark.read.parquet(str(tmp_path / "pages.parquet"))).select(*[d[0] for d in con.description])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert sum(r[3] == "revisit" for r in want) == 3


def test_round_trip_of_awkward_tables(spark):
    assert W.round_trip(pages(spark, [])).count() == 0
    twice = pages(spark).unionByName(spark.createDataFrame([(None, None, "x" * 100, "", 0), (2, "u", "x" * 100, "", 0)], pages(spark).schema))
    got = W.round_trip(twice).collect()
    assert len(got) == len(HTML) + 2
    same = [r for r in got if r.payload_bytes == 100]
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in same) == sorted(
        [("2", "response", None), ("2", "response", None), ("9", "revisit", 2), ("8", "revisit", 2), ("None", "revisit", 2)])


def archive(spark):
    return [(r.record + "\r\n\r\n").encode() for r in W.records(pages(spark)).orderBy("page_id").collect()]


def found(data):
    return [x for x in W.salvage(data)]


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_all_but_the_damaged_record(spark, zipped):
    parts = archive(spark)
    parts = [gzip.compress(p) for p in parts] if zipped else parts
    names = [x[3]["warc-record-id"] for x in found(b"".join(parts))]
    assert len(names) == len(HTML)
    for k in range(len(parts)):
        for damage in (lambda p: p[:len(p) // 2], lambda p: p[:30] + bytes([p[30] ^ 0xFF]) + p[31:], lambda p: p[:-9] + b"#" * 9,
                       lambda p: b"\0" * len(p), lambda p: p + b"stray bytes"):
            broken = [*parts[:k], damage(parts[k]), *parts[k + 1:]]
            data = b"".join(broken)
            got = found(data)
            kept = [x[3]["warc-record-id"] for x in got if x[0] == "record"]
            assert set(names) - set(kept) <= {names[k]}
            assert [n for n in kept if n in names] == [n for n in names if n in kept]
            # records and gaps cover the archive without holes
            at = 0
            for kind, start, stop, *_ in got:
                assert start == at
                at = stop
            assert at == len(data)
            assert any(x[0] == "gap" for x in got), (k, damage(parts[k])[:60])


def test_gaps_are_logged(spark, tmp_path):
    W.write(pages(spark), str(tmp_path / "w"))
    path = next(p for p in (tmp_path / "w").glob("part-*") if p.stat().st_size > 500)
    path.write_bytes(b"garbage before" + path.read_bytes() + b"WARC/1.1\r\nbroken")
    (tmp_path / "w" / f".{path.name}.crc").unlink(missing_ok=True)
    rows = W.read(spark, str(tmp_path / "w")).collect()
    assert sorted(((r.stop - r.start, r.reason) for r in rows if r.kind == "gap"), reverse=True) == [(14, "no version line"), (16, "no end of header")][::-1]
    assert sum(r.kind == "record" for r in rows) == len(HTML)


@pytest.mark.parametrize("level", [0, 9])
def test_salvage_goes_on_inside_a_member(spark, level):
    parts = archive(spark)
    names = [x[3]["warc-record-id"] for x in found(b"".join(parts))]
    lone = gzip.compress(parts[0].replace(b"urn:page", b"urn:last"))
    for k in range(len(parts)):     # one wrong byte in one record of a member of all
        at = parts[k].rindex(b"WARC-Record-ID") - 1
        broken = [*parts[:k], parts[k][:at] + b"#" + parts[k][at + 1:-2] + b"##", *parts[k + 1:]]
        got = found(gzip.compress(b"".join(broken), level) + lone)
        kept = [x[3]["warc-record-id"] for x in got if x[0] == "record"]
        assert [n for n in kept if n in names] == [*names[:k], *names[k + 1:]] and kept[-1].startswith("<urn:last")
        assert any(x[0] == "gap" and f"bytes {sum(map(len, parts[:k]))} to" in x[3] for x in got)
    rng = random.Random(5)
    noise = b"".join(gzip.decompress(gzip.compress(p)) for p in parts)
    whole = gzip.compress(noise, level)
    for cut in sorted(rng.sample(range(len(whole) // 2, len(whole)), 12)):      # a member that breaks off
        content = zlib.decompressobj(wbits=31).decompress(whole[:cut])
        complete = sum(sum(map(len, parts[:k + 1])) <= len(content) for k in range(len(parts)))
        for behind in (b"", lone):
            kept = [x[3]["warc-record-id"] for x in found(whole[:cut] + behind) if x[0] == "record"]
            assert [n for n in kept if n in names][:complete] == names[:complete]
            assert len([n for n in kept if n in names]) == len(set(kept) & set(names))
            assert not behind or kept[-1].startswith("<urn:last")


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    W.write(pages(spark, [c * 3000 for c in "abcdefghij"]).coalesce(1), str(tmp_path / "w"), file_bytes=8000)
    sizes = [p.stat().st_size for p in (tmp_path / "w").glob("part-*")]
    assert max(sizes) <= 8000
    assert W.read(spark, str(tmp_path / "w")).filter("kind = 'record'").count() == 10
