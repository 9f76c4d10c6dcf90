"""Substring dedup by paragraphs: MinHash bands find paragraphs that many texts share, also with small changes.

A paragraph is a line of at least ``min_words`` words, as a set of word n-grams. Their MinHash values are cut into bands whose number and length are tuned for the recall
asked for at the threshold. Paragraphs that collide in a band are joined, the exact Jaccard similarity decides,
and components of similar paragraphs become clusters. Of a cluster the first occurrence stays, all others go.

Equal paragraphs are one set with a count from the start, so a passage in a third of all texts is one entry.

Passages inside longer lines, or over several lines, are found by windows: the text is cut where the hash of a run
of words is the smallest of its surroundings, so equal passages are cut alike wherever they stand. Windows are
compared as equal sequences of words: under 49 words a changed word inside takes the Jaccard similarity of 5-grams
below 0.8 anyway. A passage with changes is found by the windows between them.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm import text as X
from campuswatt.llm.common import pack, partitions, runs, settle, unpack
from campuswatt.llm.linking import link, range_counts

N_GRAM, NUMERATOR, DENOMINATOR = 5, 80, 100
MIN_WORDS = 20
CUT_RUN, CUT_REACH, LONGEST = 3, 6, 16     # words of a run, runs on each side that are larger, words before a further cut
RECALL, MOST_HASHES = 0.998, 64
BUCKET_BANDS = 2_000_000
HOT = 64                       # times a band hash is found in the sample before it is not sent to its bucket
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True
_RNG = np.random.default_rng(0xBA2D)
_MULTIPLY = _RNG.integers(0, 1 << 63, MOST_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 64, MOST_HASHES, dtype=np.uint64)


def tune(threshold, recall=RECALL, most=MOST_HASHES):
    """(bands, rows): the most selective bands that reach ``recall`` at ``threshold`` with ``most`` hashes at most."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = next((b for b in range(1, most // rows + 1) if 1 - (1 - threshold ** rows) ** b >= recall), None)
        if bands is None:
            break
        best = (bands, rows)
    return best


def paragraphs(data, offsets, min_words=MIN_WORDS):
    """Text, number, start, end (bytes) and words of every paragraph, and the word hashes with their bounds."""
    lines, stops, per = X.spans(data, offsets, _NEWLINE)
    starts, ends, _ = X.spans(data, offsets)
    words = X.hashes(data, starts, ends, lower=True)
    low, high = np.searchsorted(starts, lines), np.searchsorted(starts, stops)
    text = np.repeat(np.arange(len(per)), per)
    number = np.arange(len(lines)) - np.repeat(np.cumsum(per) - per, per)
    keep = high - low >= min_words
    return text[keep], number[keep], lines[keep], stops[keep], low[keep], high[keep], words


def _sets(data, offsets, n, min_words):
    """Per paragraph: text, number, start, end, words and its n-gram set."""
    text, number, start, stop, low, high, words = paragraphs(data, offsets, min_words)
    grams = X.windows(words, n)
    for t, k, a, b, lo, hi in zip(text.tolist(), number.tolist(), start.tolist(), stop.tolist(), low.tolist(), high.tolist()):
        yield t, k, a - int(offsets[t]), b - int(offsets[t]), hi - lo, np.unique(grams[lo:max(hi - n + 1, lo + 1)])


def _key(grams):
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def band_hashes(sets, bands, rows):
    """One hash per band of every set (a matrix)."""
    sizes = np.array([len(s) for s in sets])
    grams, first = np.concatenate(sets), np.cumsum(sizes) - sizes
    out = np.empty((len(sets), bands), dtype=np.uint64)
    for b in range(bands):
        value = np.full(len(sets), b, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            low = np.minimum.reduceat(X.mix(grams * _MULTIPLY[r] + _ADD[r]), first)
            value = X.mix(value * X._STEP + low)
        out[:, b] = value
    return out


def occurrences(docs, doc_id, text, n, min_words):
    """doc_id, paragraph, start, length (bytes), n_words and key of every paragraph."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def read(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(1)):
                rows = [[] for _ in range(6)]
                for t, k, a, b, w, grams in _sets(data, offsets, n, min_words):
                    for out, value in zip(rows, (first + t, k, a, b - a, w, _key(grams))):
                        out.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[0], pa.int64())), *[pa.array(r, pa.int64()) for r in rows[1:5]],
                     pa.array(rows[5], pa.binary())], names=["doc_id", "paragraph", "start", "length", "n_words", "key"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(read, f"doc_id {kind}, paragraph long, start long, length long, n_words long, key binary"))


def _banded(texts, n, min_words, bands, rows, buckets, hot):
    """Band hashes and keys of all paragraphs, packed by bucket; those of ``hot`` hashes in bucket -1."""
    hot = np.sort(hot)

    def read(batches):
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                sets = {}
                for *_, grams in _sets(data, offsets, n, min_words):
                    sets.setdefault(_key(grams), grams)
                if not sets:
                    continue
                keys = np.frombuffer(b"".join(sets), "V16")
                value = band_hashes(list(sets.values()), bands, rows).ravel()
                who = np.repeat(np.arange(len(keys)), bands)
                bucket = (((value >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                if len(hot):
                    bucket[hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] == value] = -1
                order = np.argsort(bucket, kind="stable")
                edges = runs(bucket[order])
                parts = [order[a:b] for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[p[0]]) for p in parts], pa.int64()), pa.array([pack(value[p], 8) for p in parts], pa.binary()),
                     pa.array([keys[who[p]].tobytes() for p in parts], pa.binary())], names=["bucket", "bands", "keys"])

    return texts.mapInArrow(read, "bucket long, bands binary, keys binary")


def _postings(table):
    """Postings of the band hashes that a bucket holds for two keys or more."""
    value = np.concatenate([unpack(b, 8) for b in table.column("bands").to_pylist()])
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u8").reshape(-1, 2)
    order = np.lexsort((keys[:, 1], keys[:, 0], value))
    value, keys = value[order], keys[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (keys[1:] != keys[:-1]).any(axis=1)
    value, keys = value[fresh], keys[fresh]
    edges = runs(value)
    shared = np.repeat(np.diff(edges) > 1, np.diff(edges))
    return _posting_rows(value[shared], keys[shared])


def _posting_rows(value, keys):
    raw = np.ascontiguousarray(keys).view("V16").ravel()
    return pa.Table.from_arrays([pa.array(value.view(np.int64)), pa.array([k.tobytes() for k in raw], pa.binary())], names=["gram", "key"])


def _hot_postings(batches):
    for batch in batches:
        for b, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield from _posting_rows(unpack(b, 8), np.frombuffer(k, "<u8").reshape(-1, 2)).to_batches()


def _hot_hashes(texts, n, min_words, bands, rows, entries, buckets):
    """Band hashes that alone would fill a bucket, from a sample; only the load of tasks depends on it."""
    if entries <= 4 * BUCKET_BANDS:
        return np.empty(0, dtype=np.uint64)
    share = min(1.0, 4 * HOT / (entries // buckets + 1))
    sample = _banded(texts.sample(share, seed=3), n, min_words, bands, rows, 1, np.empty(0, np.uint64))
    found = (sample.select("bands", "keys").mapInArrow(_hot_postings, "gram long, key binary").groupBy("gram").count()
             .filter(F.col("count") >= HOT).select("gram").collect())     # at most 4 x buckets
    return np.array([r.gram for r in found], dtype=np.int64).view(np.uint64)


def _whole_sets(texts, n, min_words):
    """key, n, grams and ranges of all paragraphs (each key once a chunk)."""
    def read(batches):
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                sets = {}
                for *_, grams in _sets(data, offsets, n, min_words):
                    sets.setdefault(_key(grams), grams)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sets), pa.binary()), pa.array([len(g) for g in sets.values()], pa.int64()),
                     pa.array([g.tobytes() for g in sets.values()], pa.binary()),
                     pa.array([range_counts(g) for g in sets.values()], pa.list_(pa.int32()))], names=["key", "n", "grams", "ranges"])

    return texts.mapInArrow(read, "key binary, n long, grams binary, ranges array<int>")


def window_spans(data, offsets):
    """Text, number, first and last word (exclusive) of every window, start and end of the words, and their hashes.

    Windows lie between content-defined cuts and the ends of the text, further cut every ``LONGEST`` words; a rest
    of ``CUT_REACH`` words or less goes to the window before it, so windows have 7 to 22 words. Of an equal run the
    first one cuts. What is shorter between the end of a text and a cut is no window.
    """
    starts, ends, per = X.spans(data, offsets)
    words = X.hashes(data, starts, ends, lower=True)
    last = np.cumsum(per)
    first = last - per
    text = np.repeat(np.arange(len(per)), per)
    grams, reach = X.windows(words, CUT_RUN), CUT_REACH
    cuts = np.empty(0, dtype=np.int64)
    if len(grams) > 2 * reach:
        near = np.lib.stride_tricks.sliding_window_view(grams, reach)
        lowest = near.min(axis=1)       # of grams i .. i + reach - 1
        at = np.arange(reach, len(grams) - reach)
        at = at[(grams[at] < lowest[at - reach]) & (grams[at] <= lowest[at + 1])]
        cuts = at[(at - reach >= first[text[at]]) & (at + reach + CUT_RUN <= last[text[at]])]
    edges = np.unique(np.concatenate([cuts, first[per > 0], last[per > 0]]))
    low, high = edges[:-1], edges[1:]
    pieces = np.maximum(1, (high - low + LONGEST - reach - 1) // LONGEST)
    turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(low, pieces) + turn * LONGEST
    stop = np.where(turn + 1 == np.repeat(pieces, pieces), np.repeat(high, pieces), begin + LONGEST)
    keep = stop - begin > reach
    begin, stop = begin[keep], stop[keep]
    text = text[begin]
    number = np.arange(len(text)) - np.searchsorted(text, text)
    return text, number, begin, stop, starts, ends, words


def _window_keys(begin, stop, words):
    """128-bit hashes of the word sequences."""
    size = stop - begin
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    run = words[np.repeat(begin, size) + place]
    place = place.astype(np.uint64)
    return np.column_stack([np.add.reduceat(X.mix((run ^ X.mix(place * _MULTIPLY[k] + _ADD[k])) + _ADD[k + 2]), first) for k in (0, 1)])


def window_occurrences(docs, doc_id, text):
    """doc_id, paragraph (counted on from the last line), start, length (bytes), n_words and key of every window."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def read(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(1)):
                of, number, begin, stop, starts, ends, words = window_spans(data, offsets)
                if not len(of):
                    continue
                lines = X.spans(data, offsets, _NEWLINE)[2]
                start = starts[begin]
                keys = np.ascontiguousarray(_window_keys(begin, stop, words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + of)), pa.array(lines[of] + number), pa.array(start - offsets[of]),
                     pa.array(ends[stop - 1] - start), pa.array(stop - begin),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(of), [None, pa.py_buffer(keys)]).cast(pa.binary())],
                    names=["doc_id", "paragraph", "start", "length", "n_words", "key"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(read, f"doc_id {kind}, paragraph long, start long, length long, n_words long, key binary"))


def window_clusters(docs, doc_id="doc_id", text="text"):
    """Every window of words that occurs twice or more, in the columns of :func:`clusters`; ``paragraph`` counts on
    from the number of lines of the text. First occurrences and repeated or null ids are as there."""
    found = window_occurrences(docs, doc_id, text)
    twice = found.groupBy("key").count().filter("count > 1").select("key")
    return _marked(settle(found.join(twice, "key")).withColumn("root", F.col("key")))


def repeats(docs, doc_id="doc_id", text="text"):
    """Repeated lines (:func:`clusters`) and repeated windows (:func:`window_clusters`). Their spans may overlap."""
    return clusters(docs, doc_id, text).unionByName(window_clusters(docs, doc_id, text))


def clusters(docs, doc_id="doc_id", text="text", n=N_GRAM, numerator=NUMERATOR, denominator=DENOMINATOR, min_words=MIN_WORDS, recall=RECALL):
    """Every paragraph that occurs twice or more, the same or similar: doc_id, paragraph (line number among the
    non-empty lines of its text), start and length in bytes, n_words, first_doc_id, first_paragraph (the occurrence
    that stays) and removed.

    Null and empty texts and shorter lines have no paragraphs. Rows that repeat a doc_id are occurrences of their
    own; the first occurrence is the smallest (doc_id, paragraph), null ids last, and rows equal in both all stay.
    """
    spark = docs.sparkSession
    bands, rows = tune(numerator / denominator, recall)
    found = settle(occurrences(docs, doc_id, text, n, min_words))
    entries = found.count() * bands
    buckets = partitions(spark, entries, BUCKET_BANDS)
    texts = docs.select(F.col(text).alias("text"))
    hot = _hot_hashes(texts, n, min_words, bands, rows, entries, buckets)
    packed = _banded(texts, n, min_words, bands, rows, buckets, hot)
    postings = packed.filter("bucket >= 0").groupBy("bucket").applyInArrow(_postings, "gram long, key binary")
    if len(hot):
        postings = postings.unionByName(packed.filter("bucket = -1").select("bands", "keys")
                                        .mapInArrow(_hot_postings, "gram long, key binary").distinct())
    postings = settle(postings)
    colliding = postings.select("key").distinct()
    sets = settle(_whole_sets(texts, n, min_words).join(colliding, "key", "left_semi")
                  .groupBy("key").agg(*[F.first(c).alias(c) for c in ("n", "grams", "ranges")]))
    sized = settle(postings.join(sets.select("key", "n"), "key"))
    lengths = lambda a, b: F.least(f"{a}.n", f"{b}.n") * denominator >= F.greatest(f"{a}.n", f"{b}.n") * numerator
    known = link(sized, sets, lengths, numerator, denominator, few_grams=True)

    rooted = found.join(known.withColumnsRenamed({"node": "key"}), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return _marked(rooted)


def _marked(rooted):
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "paragraph")
    first = (rooted.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("found")).filter("found > 1"))
    return (rooted.join(first, "root").select(
        "doc_id", "paragraph", "start", "length", "n_words", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.paragraph").alias("first_paragraph"), (order != F.col("first")).alias("removed")))
