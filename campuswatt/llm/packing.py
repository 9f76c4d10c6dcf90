"""Packing documents into sequences of one length by best fit, longest piece first.

A document becomes its tokens and one end token. Overlong documents are cut into full windows first; what is
left of each is one piece. Pieces of a shard are packed longest first, each into the open window with the
least room that still holds it. A segment tree over the room left, 0 to the window length, finds that window
in a few steps. Shards hold tens of thousands of pieces, so what a shard's last windows lack is small.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from campuswatt.llm import text as X
from campuswatt.llm.common import settle, with_columns

WINDOW, END = 2048, 1
SHARD_PIECES = 50_000
KNOWN_WORDS = 1_000_000        # words a Python worker keeps the ids of
_POINT = np.zeros(256, dtype=bool)
_POINT[list(b".,;:!?")] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class WordIds:
    """Token ids of texts, a word at a time: the tokenizer lowers words and never joins across white space.

    Words are known by hash, their ids lie in one pool; a text is a gather from the pool. Points and commas
    behind a letter are a word of their own for the tokenizer, and here. Only words with ``<|`` keep their case,
    as they may be special tokens.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self):
        self.known, self.first, self.count = (np.empty(0, dtype=d) for d in (np.uint64, np.int64, np.int64))
        self.pool = np.empty(0, dtype="<u4")

    def _words(self, data, offsets):
        starts, ends, _ = X.spans(data, offsets)
        cut = ends.copy()
        for _ in range(3):
            at = np.maximum(cut - 1, starts)
            cut -= _POINT[data[at]] & (at > starts)
        bare = (cut < ends) & _ASCII_LETTER[data[cut - 1]]
        starts, ends = np.concatenate([starts, cut[bare]]), np.concatenate([np.where(bare, cut, ends), ends[bare]])
        order = np.argsort(starts)
        starts, ends = starts[order], ends[order]
        names = X.hashes(data, starts, ends, lower=True)
        marks = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        if len(marks):
            odd = np.unique(np.searchsorted(starts, marks, "right") - 1)
            names[odd] = X.mix(X.hashes(data, starts[odd], ends[odd]))
        return starts, ends, names

    def _learn(self, names, words):
        ids = self._encode(words)
        count = np.array([len(i) for i in ids], dtype=np.int64)
        first = len(self.pool) + np.cumsum(count) - count
        self.pool = np.concatenate([self.pool, *ids])
        at = np.searchsorted(self.known, names)
        self.known, self.first, self.count = (np.insert(have, at, new) for have, new in (
            (self.known, names), (self.first, first), (self.count, count)))

    def _encode(self, words):
        """Ids of each word. Words of letters alone go in lines of many, and the ids that end a word part them."""
        out, plain = [None] * len(words), [i for i, w in enumerate(words) if w.isalpha()]
        lines = [plain[k:k + 256] for k in range(0, len(plain), 256)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join([words[i] for i in x]) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) == len(line):
                for i, part in zip(line, np.split(ids, stops[:-1])):
                    out[i] = part
        rest = [i for i, o in enumerate(out) if o is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype="<u4")
        return out

    def ids(self, data, offsets):
        """Ids of all texts of a chunk in a row, and where each text's begin."""
        starts, ends, names = self._words(data, offsets)
        distinct, sample, word = np.unique(names, return_index=True, return_inverse=True)
        fresh = ~np.isin(distinct, self.known, assume_unique=True)
        if fresh.any():
            if len(self.known) + fresh.sum() > KNOWN_WORDS and len(self.known):
                self._forget()
                fresh[:] = True
            raw = data.tobytes()
            self._learn(distinct[fresh], [raw[starts[i]:ends[i]].decode("utf-8", "replace") for i in sample[fresh]])
        at = np.searchsorted(self.known, distinct)
        first, count = self.first[at][word], self.count[at][word]
        upto = np.concatenate([[0], np.cumsum(count)])
        flat = self.pool[np.repeat(first - upto[:-1], count) + np.arange(upto[-1])]
        return flat, upto[np.searchsorted(starts, offsets)]


_WORDS = {}


def word_ids(path):
    """One table of known words for all tasks of a Python worker."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def tokenizer_path(name="word_bpe_49k.json"):
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs, doc_id="doc_id", text="text", path=None, window=WINDOW, end=END):
    """doc_id, start, length, ids_crc32 and doc_tokens of the windows and the rest of every row.

    A null text is empty and has the end token alone. Repeated rows are pieces of their own.
    """
    kind, path = docs.schema[doc_id].dataType.simpleString(), path or tokenizer_path()

    def read(batches):
        words = word_ids(path)
        for batch in batches:
            for top, offsets, data in X.chunks(batch.column(1)):
                flat, first = words.ids(data, offsets)
                rows = [[] for _ in range(5)]
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    raw = flat[lo:hi].tobytes() + int(end).to_bytes(4, "little")
                    total = hi - lo + 1
                    for at in range(0, total, window):
                        part = raw[4 * at:4 * (at + window)]
                        for out, value in zip(rows, (top + i, at, len(part) // 4, zlib.crc32(part), total)):
                            out.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[0], pa.int64())), *[pa.array(r, pa.int64()) for r in rows[1:]]],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(read, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"))


class OpenWindows:
    """Open windows by the room they have left; a node of the tree says whether any window lies below it."""

    def __init__(self, window):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.stacks = [[] for _ in range(window + 1)]

    def add(self, room, window):
        self.stacks[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, need):
        """Take out a window with the least room of at least ``need``: (room, window), or None."""
        node, any_ = self.leaves + need, self.any
        while not any_[node]:
            while node & 1:        # a right child: nothing to the right below this parent
                node >>= 1
                if node <= 1:
                    return None
            if node <= 1:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if any_[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.stacks[room].pop()
        if not self.stacks[room]:
            any_[node] = 0
            node >>= 1
            while node and not (any_[2 * node] or any_[2 * node + 1]):
                any_[node] = 0
                node >>= 1
        return room, window


def best_fit(lengths, window=WINDOW):
    """Window number and offset of each piece, in the order given (longest first)."""
    open_, number, offset, last = OpenWindows(window), [], [], 0
    for n in lengths:
        room, mine = open_.tightest(n) or (window, None)
        if mine is None:
            mine, last = last, last + 1
        number.append(mine)
        offset.append(window - room)
        if room > n:
            open_.add(room - n, mine)
    return number, offset


def pack(docs, doc_id="doc_id", text="text", path=None, window=WINDOW, end=END, shard_pieces=SHARD_PIECES):
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    Every token of every row lies in one piece; the pieces of a sequence follow one another from offset 0.
    """
    cut = settle(pieces(docs, doc_id, text, path, window, end))
    shards = max(1, -(-cut.count() // shard_pieces))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield from _packed(pa.Table.from_batches(held), window)

    return (cut.repartition(shards, F.xxhash64("doc_id", "start", "ids_crc32"))
            .mapInArrow(run, with_columns(cut.schema, sequence_id="long", offset="long")))


def _packed(table, window):
    """One shard: full windows and packed pieces with their sequence and offset."""
    table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
    number, offset = best_fit(table.column("length").to_pylist(), window)
    shard = TaskContext.get().partitionId()
    yield from (table.append_column("sequence_id", pa.array((shard << 40) + np.array(number, dtype=np.int64)))
                .append_column("offset", pa.array(offset, pa.int64())).to_batches())
