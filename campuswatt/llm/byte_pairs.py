"""Byte-level BPE: encoding by a queue of merge ranks over a linked symbol list, decoding by vocabulary strings.

A text is cut at the vocabulary's added tokens and then into pieces by the pattern of the byte-level form. A
piece starts as one symbol a byte. All neighbouring pairs that have a merge stand in a priority queue by
(rank, place); the best is taken out, its two symbols become one, and the pairs with the new neighbours come
in. Symbols are doubly linked by place, and an entry whose pair no longer stands at its place is skipped.
The queue of a short piece is the list of its pairs' ranks itself, of which the smallest is looked up.
Pieces repeat, so a Python worker keeps the ids of those it met, up to a bound; that changes no result.
Ids decode into the vocabulary's bytes one after another, read as UTF-8.

Every row is encoded by itself: no shuffle, and a task holds one batch of rows.
"""

import heapq
import json
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

VOCABULARY = "byte_bpe_50k.json"
KNOWN_PIECES, KNOWN_CHARACTERS = 150_000, 64    # pieces of a generation a Python worker keeps the ids of, and the longest
CHUNK_IDS = 1 << 18                             # ids that are decoded together
SHORT = 48                                      # symbols of a piece whose ranks are a plain list

# Fixed value: the pattern of the byte-level form.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE, _ID = 1 << 62, (1 << 32) - 1     # rank of pairs without a merge; ranks carry the merged symbol's id below


def vocabulary_path(name=VOCABULARY):
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_characters():
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class _Known(dict):
    """Ids of the pieces met, in two generations: frequent pieces come back from the older one."""

    def __init__(self, ids):
        super().__init__()
        self.ids, self.older = ids, {}

    def __missing__(self, piece):
        ids = self.older.get(piece) or self.ids(piece)
        if len(piece) <= KNOWN_CHARACTERS:
            if len(self) >= KNOWN_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids = tuple(ids)      # of numbers: the collector need not look into it
        return ids


class BytePairs:
    """Vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, path):
        import regex
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec.get("added_tokens") or []
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("only plain byte-level vocabularies")
        if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must stand for their own text")
        ids, shown = model["vocab"], byte_characters()
        byte_of = {c: b for b, c in shown.items()}
        self.first = [ids[shown[b]] for b in range(0x100)]
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.added = {t["content"]: t["id"] for t in added}
        words = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()} | {i: c.encode() for c, i in self.added.items()}
        self.words = [words.get(i, b"") for i in range(max(words) + 2)]      # the last entry is for ids without a word
        self._pieces = regex.compile(PATTERN)
        names = sorted(self.added, key=lambda c: (-len(c), c))
        self._parts = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._ranks = {pair: rank << 32 | i for pair, (rank, i) in self.merges.items()}
        self._known = _Known(lambda piece: self.merged([*map(self.first.__getitem__, piece.encode())]))

    def merged(self, symbols):
        """Ids of the symbols after all merges, the best rank first and the leftmost of equal ranks."""
        n = len(symbols)
        if n < 2:
            return symbols
        symbols = list(symbols)
        if n <= SHORT:
            return self._short(symbols)
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            pair = (symbols[i], symbols[i + 1])
            if pair in merges:
                queue.append((merges[pair][0], i, pair))
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if j < 0 or symbols[i] != pair[0] or symbols[j] != pair[1]:
                continue        # one of the two became part of another symbol
            symbols[i], symbols[j] = merges[pair][1], None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                pair = (symbols[i], symbols[k])
                if pair in merges:
                    heapq.heappush(queue, (merges[pair][0], i, pair))
            h = before[i]
            if h >= 0:
                pair = (symbols[h], symbols[i])
                if pair in merges:
                    heapq.heappush(queue, (merges[pair][0], h, pair))
        return [s for s in symbols if s is not None]

    def _short(self, symbols):
        """:func:`merged` of a short piece: the smallest rank of the neighbouring pairs is looked up, the leftmost of equal ones."""
        find, none = self._ranks.get, _NONE
        ranks = [*map(find, zip(symbols, symbols[1:]), repeat(none))]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i] = one = best & _ID
            del symbols[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find((one, symbols[i + 1]), none)
            if i:
                ranks[i - 1] = find((symbols[i - 1], one), none)
        return symbols

    def encode(self, text):
        """Ids of a text; its added tokens are single ids."""
        parts = self._parts.split(text) if self._parts and any(c in text for c in self.added) else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
            else:
                out.extend(chain.from_iterable(map(self._known.__getitem__, self._pieces.findall(part))))
        return out

    def decode(self, ids, counts):
        """Texts of consecutive runs of ``ids``, ``counts`` of them each. Ids without a word give nothing."""
        last = len(self.words) - 1
        known = np.where((ids < 0) | (ids > last), last, ids).tolist()
        stops = np.concatenate([[0], np.cumsum(counts)]).tolist()
        return [b"".join(map(self.words.__getitem__, known[a:b])).decode("utf-8", "replace") for a, b in zip(stops, stops[1:])]


_LOADED = {}


def load(path):
    """The tokenizer of a file, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def _with(df, into, kind):
    """The columns of ``df`` without ``into``, and the schema with it at the end."""
    rest = [f for f in df.schema.fields if f.name != into]
    return [F.col(f"`{f.name}`") for f in rest], T.StructType([*rest, T.StructField(into, kind)])


def encode(df, text="text", into="ids", path=None):
    """``df`` with the token ids of ``text`` in ``into`` (a column of that name is replaced). A null text has no ids."""
    path = path or vocabulary_path()
    rest, schema = _with(df, into, T.ArrayType(T.IntegerType()))

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            ids = [np.array(tokenizer.encode(t or ""), dtype=np.int32) for t in batch.column(batch.num_columns - 1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=schema.names)

    return df.select(*rest, F.col(text).alias("\x00text")).mapInArrow(run, schema)


def decode(df, ids="ids", into="decoded", path=None):
    """``df`` with the text of the token ids in ``into`` (a column of that name is replaced).

    Bytes that are no UTF-8 become replacement characters. Null ids and ids outside the vocabulary give
    nothing; a null list gives an empty text.
    """
    path = path or vocabulary_path()
    rest, schema = _with(df, into, T.StringType())

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            stops, out, first = np.concatenate([[0], np.cumsum(counts)]), [], 0
            while first < len(counts):
                last = max(first + 1, int(np.searchsorted(stops, stops[first] + CHUNK_IDS, "right")) - 1)
                out += tokenizer.decode(values[stops[first]:stops[last]], counts[first:last])
                first = last
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], names=schema.names)

    return df.select(*rest, F.col(ids).cast("array<int>").alias("\x00ids")).mapInArrow(run, schema)


def round_trip(docs, doc_id="doc_id", text="text", path=None):
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by commas) and of the decoded text, of every row.

    A null text is empty. Repeated rows give repeated results. Other columns are not read.
    """
    coded = decode(encode(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), path=path).drop("text"), path=path)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                        digest(F.col("decoded")).alias("decoded_sha256"))
