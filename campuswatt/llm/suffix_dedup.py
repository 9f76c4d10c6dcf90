"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts anywhere else.

1. *Anchors.* Every string of ``length`` bytes has a smallest k-gram hash, its anchor, so equal
   strings have equal anchors. Strings in a row with one anchor form a piece. Only pieces whose
   anchor occurs in another piece can hold a repeat; the rest of the text needs no sorting.
2. *Shards.* Equal pieces fall together with a count before they move. Pieces meet by anchor, so all
   places that may be equal are in one shard; an anchor with very many pieces is spread over several
   shards. Each shard sorts its suffixes by Larsson-Sadakane refinement and takes the common prefixes
   of neighbours by Kasai's scan, both in numpy.
3. *Merging.* Shards that share an anchor send their distinct strings as sorted fingerprints, and each
   list is searched in the others by binary search.

The repeated strings go back to the texts they lie in, and a text is cut once. Equal texts are one text
with a count: if there are two, all their strings repeat.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm import text as X
from campuswatt.llm.common import own_name, partitions, runs, settle

LENGTH = 200
GRAM = 32                      # bytes of an anchor
SHARD_PIECES = 4_000           # some 1.2 MB of pieces, whose ranks stay near the processor
ANCHOR_PIECES = 4_000          # occurrences from which an anchor is spread over shards
MERGE_STRINGS = 1_000_000      # fingerprints a merging task holds
LANES = 16_384                 # lanes of Kasai's scan


# --- anchors ---------------------------------------------------------------------

def _gram_hashes(data, gram):
    out, n = X._BYTE[data], 1
    while n < gram:
        step = min(n, gram - n)
        rest = len(out) - step
        out = X.mix(out[:rest] * X._STEP + out[step:] * X._BASE)
        n += step
    return out


def _window_min(values, width):
    n = 1
    while n * 2 <= width:
        values, n = np.minimum(values[:-n], values[n:]), n * 2
    rest = width - n
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def pieces(data, length=LENGTH, gram=GRAM):
    """Anchor, first and number of strings of each piece of one text."""
    if len(data) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    anchors = np.concatenate([
        _window_min(_gram_hashes(data[lo:lo + X.CHUNK_BYTES + length - 1], gram), length - gram + 1)
        for lo in range(0, len(data) - length + 1, X.CHUNK_BYTES)])      # long texts in overlapping parts
    edges = runs(anchors)
    return anchors[edges[:-1]], edges[:-1], np.diff(edges)


def anchor_places(data, length=LENGTH, gram=GRAM):
    """Distinct anchors of a text and the number of places each has (also inside one piece)."""
    width, found, places = length - gram + 1, [], []
    for lo in range(0, len(data) - length + 1, X.CHUNK_BYTES):
        grams = _gram_hashes(data[lo:lo + X.CHUNK_BYTES + length - 1], gram)
        edge = np.zeros(width - 1, dtype=np.uint64)
        # a gram is an anchor if the largest minimum of the strings around it is its own hash
        high = ~_window_min(~np.concatenate([edge, _window_min(grams, width), edge]), width)
        at = np.flatnonzero(high == grams)
        found.append(grams[at])
        places.append(lo + at)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    _, first = np.unique(np.concatenate(places), return_index=True)
    return np.unique(np.concatenate(found)[first], return_counts=True)


# --- suffix array ----------------------------------------------------------------

def suffix_array(data, depth):
    """Suffixes of ``data`` in the order of their first ``depth`` bytes, and their ranks, by prefix doubling.

    Larsson and Sadakane's refinement: ranks by h bytes give ranks by 2h bytes, and suffixes whose rank
    is theirs alone are not touched again. The last step reaches just to ``depth``, so equal ranks mean equal
    strings; ``depth`` is 8 or more.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    head = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        head = (head << np.uint64(8)) | padded[k:k + n]
    order = np.argsort(head)
    edges = runs(head[order])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(edges[:-1], np.diff(edges))     # a group's rank is its first place
    sizes = np.diff(edges)
    shared = sizes > 1
    at = _spread(edges[:-1][shared], sizes[shared])         # places of the groups still open
    h = 8
    while h < depth and len(at):
        who = order[at]
        after = who + min(h, depth - h)
        key = (rank[who].astype(np.uint64) << np.uint64(32)) | np.where(
            after < n, rank[np.minimum(after, n - 1)] + 1, 0).astype(np.uint64)
        by = np.argsort(key)
        key, who = key[by], who[by]
        order[at] = who
        edges = runs(key)
        sizes = np.diff(edges)
        rank[who] = np.repeat(at[edges[:-1]], sizes)
        at = at[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order, rank


def _spread(starts, sizes):
    """All places of runs given by start and size."""
    if len(starts) == 0:
        return np.empty(0, dtype=np.int64)
    out = np.ones(int(sizes.sum()), dtype=np.int64)
    out[0] = starts[0]
    out[np.cumsum(sizes)[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(out)


def common_prefixes(data, order, rank, cap):
    """Common prefix (at most ``cap`` bytes) of each suffix with the one before it in ``order``.

    Kasai's scan in text order, where a prefix is at most one byte shorter than the one before. The text is
    walked in lanes, all lanes a step at a time. Suffixes of one rank share ``cap`` bytes without a look; as
    the order among them is open, the scan starts anew after them.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(cap + 1, dtype=np.uint8)])
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, dtype=np.int16)
    out[order[1:]] = np.where(rank[order[1:]] == rank[order[:-1]], cap, 0)
    todo = np.flatnonzero(out == 0)
    follows = np.zeros(len(todo) + 1, dtype=bool)
    follows[1:-1] = todo[1:] == todo[:-1] + 1
    todo = np.append(todo, 0)
    lane = max(64, len(todo) // LANES)
    at = np.arange(0, len(todo) - 1, lane)
    stop, size = np.minimum(at + lane, len(todo) - 1), np.zeros(len(at), dtype=np.int64)
    while len(at):
        here = todo[at]
        other = before[here]
        same = (padded[here + size] == padded[other + size]) & (size < cap) & (other >= 0)
        done = ~same
        out[here[done]] = size[done]
        at = at + done
        size = np.where(same, size + 1, np.where(follows[at], np.maximum(size - 1, 0), 0))
        if (at >= stop).any():
            live = at < stop
            at, stop, size = at[live], stop[live], size[live]
    return out[order]


def repeated_strings(data, valid, depth):
    """Marks the starts in ``valid`` whose string of ``depth`` bytes starts at another of them too."""
    order, rank = suffix_array(data, depth)
    prefix = common_prefixes(data, order, rank, depth)
    place = np.flatnonzero(valid[order])
    many = np.zeros(len(data), dtype=bool)
    if len(place) > 1:     # the shortest prefix between two neighbours is what they share
        between = np.column_stack([place[:-1] + 1, place[1:] + 1]).ravel()
        equal = np.minimum.reduceat(np.append(prefix, 0), between)[::2] >= depth
        many[order[place[1:][equal]]] = True
        many[order[place[:-1][equal]]] = True
    return many


# --- Spark -----------------------------------------------------------------------

def _anchor_rows(length, gram):
    """(anchor, key, places) of every text."""
    def read(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(1)):
                own = [anchor_places(data[lo:hi], length, gram) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                row = np.repeat(np.arange(first, first + len(own)), [len(a) for a, _ in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([a for a, _ in own]).view(np.int64)), batch.column(0).take(pa.array(row)),
                     pa.array(np.concatenate([n for _, n in own]))], names=["anchor", "key", "places"])

    return read


def _wanted(raw, anchors, length, gram):
    """(anchor, first string, strings) of the pieces whose anchor is listed."""
    wanted = np.sort(np.array(anchors, dtype=np.int64).view(np.uint64))
    found, first, size = pieces(np.frombuffer(raw, np.uint8), length, gram)
    hit = wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found
    return zip(found[hit].view(np.int64).tolist(), first[hit].tolist(), size[hit].tolist())


def _piece_id(piece):
    return hashlib.blake2b(piece, digest_size=16).digest()


_PIECE = "shard long, anchor long, spread long, id binary, piece binary"


def _piece_rows(length, gram, shards, most):
    """The pieces of a text whose anchor repeats, each with its shard."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def read(batches):
        for batch in batches:
            rows = [[] for _ in kinds]
            for raw, anchors, places in zip(*(batch.column(c) for c in ("bytes", "anchors", "places"))):
                raw, anchors = raw.as_py(), anchors.as_py()
                spread_over = {a: -(-n // most) for a, n in zip(anchors, places.as_py()) if n > most}
                for anchor, lo, n in _wanted(raw, anchors, length, gram):
                    piece = raw[lo:lo + n + length - 1]
                    name, spread = _piece_id(piece), 0
                    if anchor in spread_over:
                        spread = 1 + int.from_bytes(name[:8], "little") % spread_over[anchor]
                    _add(rows, (anchor + spread * 0x9E3779B97F4A7C15) % (1 << 64) % shards, anchor, spread, name, piece)
                if len(rows[0]) >= 20_000:
                    yield _batch(rows, kinds, _PIECE)
                    rows = [[] for _ in kinds]
            yield _batch(rows, kinds, _PIECE)

    return read


def _batch(rows, kinds, schema):
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)],
                                      names=[c.split()[0] for c in schema.split(", ")])


_FOUND = "id binary, shard long, spread long, piece binary, marks binary, high binary, low binary, range long"
_FOUND_KINDS = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())


def _sort_shard(table, length, ranges):
    """One shard: marks on the strings of its pieces that repeat in it, and the distinct strings of spread anchors.

    A piece that equals another one and has its anchor to itself repeats as a whole and with nothing else.
    """
    ids, found, spread = table.column("id").to_pylist(), table.column("found").to_numpy(), table.column("spread").to_pylist()
    blobs, shard = table.column("piece").to_pylist(), table.column("shard")[0].as_py()
    anchors = table.column("anchor").to_numpy()
    _, home, per = np.unique(anchors, return_inverse=True, return_counts=True)
    alone = (per[home] == 1) & (found > 1) & (table.column("spread").to_numpy() == 0)
    marks = [np.ones(len(b) - length + 1, dtype=bool) if n > 1 else None for b, n in zip(blobs, found.tolist())]
    sort = np.flatnonzero(~alone).tolist()
    if sort:
        sizes = np.array([len(blobs[i]) for i in sort], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join([blobs[i] for i in sort]), np.uint8)
        valid = np.ones(len(data), dtype=bool)
        valid[_spread(first[1:] - (length - 1), np.full(len(sort), length - 1))] = False
        many = repeated_strings(data, valid, length)
        for i, lo, n in zip(sort, first.tolist(), sizes.tolist()):
            if marks[i] is None:
                marks[i] = many[lo:lo + n - length + 1]
    rows = [[] for _ in _FOUND_KINDS]
    for name, s, blob, mark in zip(ids, spread, blobs, marks):
        if s or mark.any():
            _add(rows, name, shard, s, blob if s else None, np.packbits(mark).tobytes(), None, None, -1)
    for s in sorted({s for s in spread if s}):
        high, low = _sorted_fingerprints([b for b, t in zip(blobs, spread) if t == s], length)
        home = _range(high, ranges)
        edges = runs(home)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            _add(rows, None, shard, s, None, None, high[a:b].tobytes(), low[a:b].tobytes(), int(home[a]))
    return pa.Table.from_batches([_batch(rows, _FOUND_KINDS, _FOUND)])


def _add(rows, *values):
    for out, value in zip(rows, values):
        out.append(value)


def _range(high, ranges):
    return (((high >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _fingerprints(blob, length):
    """Two 64-bit fingerprints of every string of a piece."""
    data = np.frombuffer(blob, np.uint8)
    starts = np.arange(len(data) - length + 1)
    return X.hashes(data, starts, starts + length), X.hashes(data ^ np.uint8(0xA5), starts, starts + length)


def _sorted_fingerprints(blobs, length):
    """Distinct fingerprints of all strings of some pieces, in order."""
    high, low = (np.concatenate(x) for x in zip(*[_fingerprints(b, length) for b in blobs]))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    fresh = np.ones(len(high), dtype=bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    return high[fresh], low[fresh]


def _held(high, low, h, l):
    """How often each (h, l) is in the sorted list (high, low), by binary search."""
    at, upto = np.searchsorted(high, h, "left"), np.searchsorted(high, h, "right")
    count = np.zeros(len(h), dtype=np.int64)
    for k in range(int((upto - at).max()) if len(h) else 0):
        here = np.minimum(at + k, len(low) - 1)
        count += (at + k < upto) & (low[here] == l)
    return count


_SHARED = "shard long, spread long, high binary, low binary"


def _merge(table):
    """One fingerprint range: of each shard's list what the other lists hold too."""
    lists = [(np.frombuffer(h, "<u8"), np.frombuffer(l, "<u8"))
             for h, l in zip(table.column("high").to_pylist(), table.column("low").to_pylist())]
    high, low = (np.concatenate(x) for x in zip(*lists))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    fresh = np.ones(len(high), dtype=bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    found = np.diff(np.append(np.flatnonzero(fresh), len(high)))
    twice = found > 1
    high, low = high[fresh][twice], low[fresh][twice]
    shared = [_held(high, low, h, l) > 0 for h, l in lists]
    return pa.Table.from_arrays(
        [table.column("shard"), table.column("spread"), pa.array([h[m].tobytes() for (h, _), m in zip(lists, shared)], pa.binary()),
         pa.array([l[m].tobytes() for (_, l), m in zip(lists, shared)], pa.binary())], names=["shard", "spread", "high", "low"])


def _mark_shared(length):
    """Pieces of one shard's list: their own marks and those of strings other shards hold too."""
    def run(pieces_, lists):
        high = np.concatenate([np.frombuffer(h, "<u8") for h in lists.column("high").to_pylist()] or [np.empty(0, "<u8")])
        low = np.concatenate([np.frombuffer(l, "<u8") for l in lists.column("low").to_pylist()] or [np.empty(0, "<u8")])
        order = np.lexsort((low, high))
        high, low, marks = high[order], low[order], []
        for blob, own in zip(pieces_.column("piece").to_pylist(), pieces_.column("marks").to_pylist()):
            mark = np.unpackbits(np.frombuffer(own, np.uint8), count=len(blob) - length + 1).astype(bool)
            marks.append(np.packbits(mark | (_held(high, low, *_fingerprints(blob, length)) > 0)).tobytes())
        return pa.Table.from_arrays([pieces_.column("id"), pa.array(marks, pa.binary())], names=["id", "marks"])

    return run


def _text_places(length, gram):
    """(key, first, strings, id) of the candidate pieces of each text."""
    def read(batches):
        for batch in batches:
            row, first, size, ids = [], [], [], []
            for i, (raw, anchors) in enumerate(zip(batch.column("bytes"), batch.column("anchors"))):
                raw = raw.as_py()
                for _, lo, n in _wanted(raw, anchors.as_py(), length, gram):
                    row.append(i)
                    first.append(lo)
                    size.append(n)
                    ids.append(_piece_id(raw[lo:lo + n + length - 1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row, pa.int64())), pa.array(first, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(ids, pa.binary())], names=["key", "first", "size", "id"])

    return read


def _cut(length, whole):
    """Bytes left, bytes removed and runs removed of each text with repeats."""
    def read(batches):
        for batch in batches:
            rows = [[] for _ in range(3)]
            for raw, copies, firsts, sizes, marks in zip(
                    *(batch.column(c).to_pylist() for c in ("bytes", "copies", "first", "size", "marks"))):
                data = np.frombuffer(raw, np.uint8)
                begins = np.zeros(len(data) + 1, dtype=bool)
                if copies > 1:
                    begins[:len(data) - length + 1] = True
                for lo, n, mark in zip(firsts or (), sizes or (), marks or ()):
                    begins[lo:lo + n] |= np.unpackbits(np.frombuffer(mark, np.uint8), count=n).astype(bool)
                starts = np.flatnonzero(begins)
                cover = np.zeros(len(data) + 1, dtype=np.int64)
                cover[starts] += 1
                cover[starts + length] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                kept = data[~gone].tobytes()
                rows[0].append(kept.decode("utf-8", "ignore").encode() if whole else kept)
                rows[1].append(int(gone.sum()))
                rows[2].append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64())],
                names=["key", "kept", "n_removed", "n_spans"])

    return read


def repeats(docs, text="text", length=LENGTH, gram=GRAM, whole=False, anchor_pieces=ANCHOR_PIECES):
    """key, kept (bytes), n_removed and n_spans of every distinct text that loses bytes.

    ``key`` is the first half of the SHA-256 of the text (``text_key``). Texts are judged on the input, not on
    what is left. Null, empty and short texts lose nothing and have no row; other columns are not read. With
    ``whole`` a character that is cut in the middle is left out of ``kept``.
    """
    spark = docs.sparkSession
    gram = min(gram, length)
    texts = docs.select(F.col(text).alias("text")).filter(F.octet_length("text") >= length)
    texts = texts.select(text_key("text").alias("key"), F.col("text").cast("binary").alias("bytes"))
    anchors = settle(texts.mapInArrow(_anchor_rows(length, gram), "anchor long, key binary, places long"))
    known = settle(anchors.groupBy("anchor").agg(F.sum("places").alias("places")).filter("places > 1"))
    mine = (anchors.select("anchor", "key").join(known, "anchor").groupBy("key", "anchor").agg(F.max("places").alias("places"))
            .groupBy("key").agg(F.collect_list(F.struct("anchor", "places")).alias("mine")))
    unique = texts.groupBy("key").agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"))
    cands = settle(unique.join(mine, "key").select("key", "bytes", "copies", F.col("mine.anchor").alias("anchors"),
                                                  F.col("mine.places").alias("places")))

    count = cands.agg(F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()[0]
    shards, ranges = partitions(spark, count, SHARD_PIECES), partitions(spark, count * length, MERGE_STRINGS)
    rows = cands.select("bytes", "anchors", "places").mapInArrow(_piece_rows(length, gram, shards, anchor_pieces), _PIECE)
    distinct = rows.groupBy("shard", "anchor", "spread", "id").agg(F.count("*").alias("found"), F.first("piece").alias("piece"))
    shard = settle(distinct.groupBy("shard").applyInArrow(lambda t: _sort_shard(t, length, ranges), _FOUND))

    # what shards of one anchor hold in common, as marks on their pieces
    shared = shard.filter("range >= 0").groupBy("range").applyInArrow(_merge, _SHARED)
    spread = (shard.filter("piece IS NOT NULL").select("shard", "spread", "id", "piece", "marks").groupBy("shard", "spread")
              .cogroup(shared.groupBy("shard", "spread")).applyInArrow(_mark_shared(length), "id binary, marks binary"))
    marks = shard.filter("piece IS NULL AND id IS NOT NULL").select("id", "marks").unionByName(spread)

    places = cands.select("key", "bytes", "anchors").mapInArrow(
        _text_places(length, gram), "key binary, first long, size long, id binary")
    hits = places.join(marks, "id").groupBy("key").agg(F.collect_list(F.struct("first", "size", "marks")).alias("hits"))
    return (cands.select("key", "bytes", "copies").join(hits, "key", "left").filter("copies > 1 OR hits IS NOT NULL")
            .select("key", "bytes", "copies", *[F.col(f"hits.{c}").alias(c) for c in ("first", "size", "marks")])
            .mapInArrow(_cut(length, whole), "key binary, kept binary, n_removed long, n_spans long"))


def text_key(text):
    """Identity of a text: the first 16 bytes of its SHA-256."""
    return F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16)


def dedup(docs, doc_id="doc_id", text="text", length=LENGTH, gram=GRAM, anchor_pieces=ANCHOR_PIECES):
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; a null text is empty."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    cut = repeats(docs, text, length, gram, anchor_pieces=anchor_pieces).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha"))
    return (rows.withColumn("key", F.substring(F.unhex("sha"), 1, 16)).join(cut, "key", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha", "sha").alias("kept_sha256")))


def removed(docs, text="text", length=LENGTH, gram=GRAM):
    """``docs`` with every repeated string cut out of ``text``, all columns and rows kept.

    A character that is cut in the middle goes as a whole. A null text stays null.
    """
    key, kept = own_name(docs, "key"), own_name(docs, "kept")
    cut = (repeats(docs, text, length, gram, whole=True)
           .select(F.col("key").alias(key), F.col("kept").cast("string").alias(kept)))
    return (docs.withColumn(key, text_key(text)).join(cut, key, "left")
            .withColumn(text, F.coalesce(kept, text)).select(*docs.columns))
