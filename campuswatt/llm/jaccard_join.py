"""N-gram Jaccard join: documents whose sets of word n-grams are similar, by rare-first prefix filtering.

A set is ordered by how many documents hold each n-gram, rarest first. Two sets of similarity
t or more share one of their first ``n - ceil(t n) + 1`` n-grams, so only these prefixes are
joined; a length, a positional and a suffix filter thin out the matches inside the join, and
each surviving pair is verified once on the whole sets.

Counting sends every n-gram of every document once, packed by hash range. An n-gram that only one
document holds can neither match nor count in an intersection, so only repeated ones come back to
their documents; a document with too few of them is done.

Groups of near copies are not expanded into all pairs (``linking``): links inside a component that is known
already are not looked at, all other pairs are.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from campuswatt.llm import text as X
from campuswatt.llm.common import own_name, pack, partitions, row_key, runs, settle, unpack
from campuswatt.llm.linking import enough, link, range_counts

N_GRAM, NUMERATOR, DENOMINATOR = 5, 80, 100
BUCKET_NGRAMS = 2_000_000      # n-grams a counting task holds
GROUP_DOCS = 8192              # documents whose repeated n-grams meet in one task
HELD = 1_000_000               # n-grams a reading task holds before it sends them
HOT_SHARE = 64                 # occurrences in the sample from which an n-gram is not sent to its bucket


def document_sets(offsets, data, n):
    """Sorted distinct n-gram hashes of each text; a shorter text is one n-gram, an empty one none."""
    starts, ends, counts = X.spans(data, offsets)
    words = X.hashes(data, starts, ends, lower=True)
    grams, at = X.windows(words, n), 0
    for c in counts.tolist():
        if c >= n:
            yield np.unique(grams[at:at + c - n + 1])
        else:
            yield np.array([X.fold(words[at:at + c])], dtype=np.uint64) if c else np.empty(0, np.uint64)
        at += c


def set_key(grams):
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signatures(docs, doc_id="doc_id", text="text", n=N_GRAM):
    """doc_id, key (of the set; null if empty), n_shingles and row (identity of id and text) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def read(batches):
        for batch in batches:
            keys, sizes = [], []
            for _, offsets, data in X.chunks(batch.column(1)):
                for grams in document_sets(offsets, data, n):
                    keys.append(set_key(grams) if len(grams) else None)
                    sizes.append(len(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), batch.column(2)],
                names=["doc_id", "key", "n_shingles", "row"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row_key(doc_id, text).alias("row"))
            .mapInArrow(read, f"doc_id {kind}, key binary, n_shingles long, row binary"))


def _bucket(grams, buckets):
    return (((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _identity(bucket, low):
    return (np.asarray(bucket % 65536, dtype=np.uint64) << np.uint64(48)) | low


_REQUEST = "bucket long, keys binary, sizes binary, counts binary, grams binary"


def _requests(texts, n, buckets, hot):
    """Every n-gram of every document to the bucket of its hash, document by document."""
    hot = np.sort(hot)

    def send(held, keys):
        grams = np.concatenate(held)
        sizes = np.array([len(g) for g in held], dtype=np.int64)
        doc = np.repeat(np.arange(len(held), dtype=np.int64), sizes)
        if len(hot):
            keep = hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] != grams
            grams, doc = grams[keep], doc[keep]
        bucket = _bucket(grams, buckets)
        order = np.argsort(bucket, kind="stable")
        grams, doc, bucket = grams[order], doc[order], bucket[order]
        keys = np.frombuffer(b"".join(keys), dtype="V16")
        edges, rows = runs(bucket), [[] for _ in range(5)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            part = runs(doc[lo:hi])
            own = doc[lo:hi][part[:-1]]
            for out, value in zip(rows, (int(bucket[lo]), keys[own].tobytes(), sizes[own].astype("<i4").tobytes(),
                                         np.diff(part).astype("<i4").tobytes(), pack(grams[lo:hi], 6))):
                out.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64())] + [pa.array(r, pa.binary()) for r in rows[1:]],
            names=["bucket", "keys", "sizes", "counts", "grams"])

    def read(batches):
        held, keys, seen, total = [], [], set(), 0
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                for grams in document_sets(offsets, data, n):
                    key = set_key(grams)
                    if not len(grams) or key in seen:
                        continue
                    seen.add(key)
                    held.append(grams)
                    keys.append(key)
                    total += len(grams)
                    if total >= HELD:
                        yield send(held, keys)
                        held, keys, seen, total = [], [], set(), 0
        if held:
            yield send(held, keys)

    return texts.mapInArrow(read, _REQUEST)


def _repeated(tables, groups):
    """One bucket: the n-grams found in two documents or more go on to the groups of their documents."""
    bucket, keys, sizes, counts, grams = None, [], [], [], []
    for b, k, s, c, g in zip(*(tables.column(x).to_pylist() for x in ("bucket", "keys", "sizes", "counts", "grams"))):
        bucket = b
        keys.append(np.frombuffer(k, "V16"))
        sizes.append(np.frombuffer(s, "<i4"))
        counts.append(np.frombuffer(c, "<i4"))
        grams.append(unpack(g, 6))
    keys, sizes, counts, grams = (np.concatenate(x) for x in (keys, sizes, counts, grams))
    doc = np.repeat(np.arange(len(keys)), counts)
    order = np.argsort(grams)
    edges = runs(grams[order])
    found = np.empty(len(grams), dtype=np.int64)
    found[order] = np.repeat(np.diff(edges), np.diff(edges))
    keep = found > 1
    doc, grams, found = doc[keep], _identity(bucket, grams[keep]), found[keep]
    return _to_groups(keys, sizes, doc, grams, found, groups)


def _to_groups(keys, sizes, doc, grams, found, groups):
    own, per = np.unique(doc, return_counts=True)
    first = np.concatenate([[0], np.cumsum(per)])
    home = (np.frombuffer(keys[own].tobytes(), "<u8")[::2] % np.uint64(groups)).astype(np.int64)
    order, rows = np.argsort(home, kind="stable"), [[] for _ in range(6)]
    edges = runs(home[order])
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        at = order[lo:hi]
        items = np.concatenate([np.arange(first[i], first[i + 1]) for i in at])
        for out, value in zip(rows, (int(home[at[0]]), keys[own[at]].tobytes(), sizes[own[at]].astype("<i4").tobytes(),
                                     per[at].astype("<i4").tobytes(), grams[items].tobytes(),
                                     np.minimum(found[items], 2 ** 31 - 1).astype("<i4").tobytes())):
            out.append(value)
    return pa.Table.from_arrays([pa.array(rows[0], pa.int64())] + [pa.array(r, pa.binary()) for r in rows[1:]],
                                names=["home", "keys", "sizes", "counts", "grams", "found"])


_REPLY = "home long, keys binary, sizes binary, counts binary, grams binary, found binary"


def _hot_replies(texts, n, hot, groups, buckets):
    """Occurrences of the hot n-grams, which skip the buckets; in the order they count as the most frequent."""

    def read(batches):
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                keys, sizes, doc, grams = [], [], [], []
                for g in document_sets(offsets, data, n):
                    mine = g[np.isin(g, hot)]
                    if len(mine):
                        doc.append(np.full(len(mine), len(keys)))
                        keys.append(set_key(g))
                        sizes.append(len(g))
                        grams.append(mine)
                if keys:
                    grams = np.concatenate(grams)
                    named = _identity(_bucket(grams, buckets), grams & np.uint64((1 << 48) - 1))
                    out = _to_groups(np.frombuffer(b"".join(keys), "V16"), np.array(sizes), np.concatenate(doc), named,
                                     np.full(len(grams), 2 ** 31 - 1), groups)
                    yield from out.to_batches()

    return texts.mapInArrow(read, _REPLY)


def _need(n, numerator, denominator):
    return -(-numerator * n // denominator)


def _candidates(table, numerator, denominator):
    """One group of documents: those with enough repeated n-grams, these in order, rarest first."""
    keys, sizes, counts, grams, found = [], [], [], [], []
    for k, s, c, g, f in zip(*(table.column(x).to_pylist() for x in ("keys", "sizes", "counts", "grams", "found"))):
        keys.append(np.frombuffer(k, "V16"))
        sizes.append(np.frombuffer(s, "<i4"))
        counts.append(np.frombuffer(c, "<i4"))
        grams.append(np.frombuffer(g, "<u8"))
        found.append(np.frombuffer(f, "<i4"))
    keys, sizes, counts, grams, found = (np.concatenate(x) for x in (keys, sizes, counts, grams, found))
    distinct, home = np.unique(np.array([k.tobytes() for k in keys], dtype=object), return_inverse=True)
    size = np.zeros(len(distinct), dtype=np.int64)
    size[home] = sizes
    doc = np.repeat(home, counts)
    order = np.lexsort((grams, found, doc))
    doc, grams = doc[order], grams[order]
    fresh = np.ones(len(doc), dtype=bool)     # copies of one set repeat its n-grams
    fresh[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[fresh], grams[fresh]
    first = np.searchsorted(doc, np.arange(len(distinct) + 1))
    rows = [[] for _ in range(4)]
    for d, key in enumerate(distinct):
        mine = grams[first[d]:first[d + 1]]
        n = int(size[d])
        if len(mine) >= _need(n, numerator, denominator):
            for out, value in zip(rows, (key, n, mine.tobytes(), range_counts(mine))):
                out.append(value)
    return pa.Table.from_arrays([pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()),
                                 pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.list_(pa.int32()))],
                                names=["key", "n", "grams", "ranges"])


def _postings(sets, numerator, denominator):
    """The prefix n-grams of each candidate set with their positions in its order."""
    def read(batches):
        for batch in batches:
            keys, sizes = batch.column(0), batch.column(1).to_pylist()
            row, gram, at = [], [], []
            for i, (n, blob) in enumerate(zip(sizes, batch.column(2).to_pylist())):
                grams = np.frombuffer(blob, "<u8")
                unique = n - len(grams)      # they come first and match nothing
                prefix = grams[:n - _need(n, numerator, denominator) + 1 - unique]
                row.append(np.full(len(prefix), i))
                gram.append(prefix)
                at.append(np.arange(unique, unique + len(prefix)))
            if not row:
                continue
            row = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(gram).view(np.int64)), keys.take(row), batch.column(1).take(row),
                 pa.array(np.concatenate(at).astype(np.int32))], names=["gram", "key", "n", "at"])

    return sets.select("key", "n", "grams").mapInArrow(read, "gram long, key binary, n long, at int")


def _likely(numerator, denominator):
    """Length and positional filter of two postings of one n-gram."""
    def test(a, b):
        left = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
        return (enough(a, b, F.least(f"{a}.n", f"{b}.n"), numerator, denominator)
                & enough(a, b, left, numerator, denominator))

    return test


def _sample_hot(texts, n, total, buckets):
    """N-grams that alone would fill a bucket. Only the load of tasks depends on this sample, no result."""
    limit = total // buckets + 1
    share = min(1.0, HOT_SHARE * 4 / limit)
    if total <= 4 * BUCKET_NGRAMS:
        return np.empty(0, dtype=np.uint64)

    def read(batches):
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                for grams in document_sets(offsets, data, n):
                    yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    rows = (texts.sample(share, seed=1).mapInArrow(read, "gram long").groupBy("gram").count()
            .filter(F.col("count") >= HOT_SHARE).select("gram").collect())   # at most 4 x buckets
    return np.array([r.gram for r in rows], dtype=np.int64).view(np.uint64)


def classes(docs, doc_id="doc_id", text="text", n=N_GRAM, numerator=NUMERATOR, denominator=DENOMINATOR):
    """doc_id, n_shingles, row (identity of id and text) and root (class of the text; null without words) of every row."""
    spark = docs.sparkSession
    signed = settle(signatures(docs, doc_id, text, n))
    total = signed.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()
    buckets, groups = partitions(spark, total[0], BUCKET_NGRAMS), partitions(spark, total[1], GROUP_DOCS)
    texts = docs.select(F.col(text).alias("text"))
    hot = _sample_hot(texts, n, total[0], buckets)
    replies = (_requests(texts, n, buckets, hot).groupBy("bucket")
               .applyInArrow(lambda t: _repeated(t, groups), _REPLY))
    if len(hot):
        replies = replies.unionByName(_hot_replies(texts, n, hot, groups, buckets))
    sets = settle(replies.groupBy("home").applyInArrow(
        lambda t: _candidates(t, numerator, denominator), "key binary, n long, grams binary, ranges array<int>"))
    postings = settle(_postings(sets, numerator, denominator))

    known = link(postings, sets, _likely(numerator, denominator), numerator, denominator)
    roots = signed.join(known.withColumnsRenamed({"node": "key"}), "key", "left")
    return roots.select("doc_id", "n_shingles", "row", F.coalesce("root", "key").alias("root"))


def links(docs, doc_id="doc_id", text="text", n=N_GRAM, numerator=NUMERATOR, denominator=DENOMINATOR):
    """doc_id, n_shingles, component_id and row (identity of id and text) of every row of ``docs``.

    Words are split at ASCII blanks with A-Z lowered. A null or blank text has no n-grams and is its own
    component; a text of fewer than ``n`` words is one n-gram. Rows with equal sets, repeated rows
    included, share a component. A null doc_id keeps its row; it is never the smallest of a component with
    another id. Other columns of ``docs`` are not read. N-grams are compared by hashes of 48 bits and more.
    """
    roots = classes(docs, doc_id, text, n, numerator, denominator)
    smallest = roots.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return roots.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row")


def one_each(docs, doc_id="doc_id", text="text", **how):
    """One row of each class of ``docs``: that with the smallest doc_id, a null id last.

    Of rows with the same id the choice goes by their text, and rows equal in both are alike. Texts without words
    are classes of their own; of rows equal in id and text one stays.
    """
    row, root, nth = (own_name(docs, c) for c in ("row", "root", "nth"))
    of_row = classes(docs, doc_id, text, **how).select(F.col("row").alias(row), F.col("root").alias(root)).distinct()
    first = F.row_number().over(W.partitionBy(F.coalesce(root, row)).orderBy(F.asc_nulls_last(doc_id), row))
    return (docs.withColumn(row, row_key(doc_id, text)).join(of_row, row).withColumn(nth, first)
            .filter(F.col(nth) == 1).select(*docs.columns))
