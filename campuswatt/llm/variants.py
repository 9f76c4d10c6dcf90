"""Spelling variants of words, found by walking a relational trie with at most one edit.

The words' trie is a table of edges. Only nodes where words part or end are kept, so an edge carries a label of
one letter or more, and a long letter run that shares nothing is one edge. A state (word, place, node, edits)
says how a word can be read down to a node. Level by level the frontier of states is joined with the edges of
that level: a state without an edit meets all edges of its node, matching or using up its edit inside the label;
a state with an edit meets only the edge of its next letter. A state lives on if the node's next letters hold
the word's next one. A word read to its end with one edit at a node where a word ends has found a neighbour.
One edit leaves a half of the word as it is, so words enter the frontier at the node of their first half, once
as they are and once reversed.

Nodes are known by a hash of their prefix. A collision could only add candidates, and every pair that is found
is checked letter by letter. The states of a node that many words share are dealt into parts, and the edges of
that node are repeated for each part.
"""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm.common import settle

# What a word is, and what its variants must have.
RUN = r"[A-Za-zÀ-ÿ]"
LETTERS, OCCURRENCES, TIMES, ODD = 7, 2, 10, 31

HELD_WORDS, HELD_LETTERS = 200_000, 1 << 24     # counts a task holds before it hands them on
PART = 2000                                     # words of a node that are read together
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


def spelled(run, salt, odd=ODD):
    """The run with A-Z lowered; where ``odd`` divides its CRC-32 behind ``salt`` (a CRC-32) it loses one letter."""
    low = run.lower() if run.isascii() else run.translate(_LOWER)
    h = zlib.crc32(low.encode(), salt)
    if h % odd == 0:
        at = h % len(low)
        low = low[:at] + low[at + 1:]
    return low


def counts(docs, doc_id="doc_id", text="text", letters=LETTERS, odd=ODD):
    """(word, n) of every word of ``letters`` letters or more, all texts together."""
    runs = re.compile(f"{RUN}{{{letters},}}")      # a shorter run cannot give such a word

    def count(batches):
        held, size = Counter(), 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                salt = zlib.crc32(f"{'' if name is None else name}:".encode())
                for run, n in Counter(runs.findall(value or "")).items():
                    word = spelled(run, salt, odd)
                    if len(word) >= letters:
                        if word not in held:
                            size += len(word)
                        held[word] += n
                if len(held) >= HELD_WORDS or size >= HELD_LETTERS:
                    yield _counted(held)
                    held, size = Counter(), 0
        yield _counted(held)

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held):
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


# --- the trie ------------------------------------------------------------------------

_ONWARD, _BACKWARD = ">", "<"      # first letter of words as they are, and of reversed ones


def _sides(words):
    """Every word as it is and reversed, each behind its mark."""
    mark = F.array(F.concat(F.lit(_ONWARD), F.col("word")), F.concat(F.lit(_BACKWARD), F.reverse("word")))
    return words.select(F.explode(mark).alias("word"))


def _shared(a, b):
    """Letters that two words begin with together."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _half(word):
    """Length of the prefix that is the word's half: rounded down, of reversed words up."""
    letters = len(word) - 1
    return 1 + (letters // 2 if word[0] == _ONWARD else letters - letters // 2)


class _Node:
    """A kept prefix: its length, a word below, and what is known of the words below."""

    __slots__ = ("depth", "word", "open", "ends", "held", "sizes", "below")

    def __init__(self, depth, word):
        self.depth, self.word, self.open, self.ends, self.held, self.sizes, self.below = depth, word, False, False, 0, 0, []


def _grown(words, least, left, right):
    """The topmost kept nodes of sorted words; they share ``left`` and ``right`` letters with the words before and behind."""
    tops, path, before = [], [], ""

    def close():
        node = path.pop()
        if path:
            up = path[-1]
            up.held += node.held
            up.sizes |= node.sizes
            up.below.append(node)
        else:
            tops.append(node)

    def at(depth, word):
        k = len(path)
        while k and path[k - 1].depth > depth:
            k -= 1
        if not k or path[k - 1].depth < depth:      # all words so far below it are below the next node of the path
            path.insert(k, _Node(depth, word))
            k += 1
        return path[k - 1]

    for i, word in enumerate(words):
        shared = _shared(before, word)
        if shared >= least:
            at(shared, word)
        while path and path[-1].depth > shared:
            close()
        at(least, word)
        at(_half(word), word)
        for depth in range(least, 1 + max(0 if i else left, 0 if i < len(words) - 1 else right)):
            at(depth, word).open = True
        end = at(len(word), word)
        end.ends, end.held, end.sizes, before = True, end.held + 1, end.sizes | 1 << len(word) % 64, word
    while path:
        close()
    return tops


def _prefixes(words, least, part=PART):
    """Rows of the trie's nodes: one for every edge behind a node and one for a word that ends there.

    ``next`` is the first letter of the edge's label as a code point, so that it needs no sort, or 0 for a word. An edge
    has its level, its label and its child; a word has its half: the length, the node, its level. Words that share ``least``
    letters are read by one task in sorted order, some ``5 * part`` at a time, so that a node is known as a whole when
    its words have been read. Only where more than ``25 * part`` words share ``least`` letters are they cut: the nodes
    that both sides have are ``open`` (of an edge: the upper node, of a word: its half) or ``child_open``, all sides keep
    all of them, and their numbers are to be added up. An open node without one above comes without ``node``.
    """
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(),
             pa.string(), pa.string(), pa.int32(), pa.int64())
    names = ["level", "node", "next", "parts", "open", "label", "child", "child_open", "ends", "held", "sizes", "following", "word", "pos", "half"]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names=names)

    def hashed(node, letters):
        for c in letters:
            node = (node * _BASE + ord(c) + 1) % _PRIME
        return node

    def rows_of(held, left, right):
        out, halves = [], {}
        todo = [(top, None, None, 0, -1) for top in _grown(held, least, left, right)]
        while todo:
            node, up, up_hash, up_parts, level = todo.pop()
            depth, word, sizes = node.depth, node.word, node.sizes
            label = word[up.depth if up else 0:depth]
            name, level, parts = hashed(up_hash or 0, label), level + 1, -(-node.held // part)
            halves[depth] = (name, level, parts, node.open)
            if up or node.open:
                following = "".join([n.word[depth] for n in node.below])
                out.append((level - 1, up_hash, ord(label[0]) if up else None, up_parts, up.open if up else False, label, name, node.open, node.ends,
                            node.held, sizes - (1 << 64) if sizes >> 63 else sizes, following, None, None, None))
            if node.ends:
                pos = _half(word)
                half, at, parts_there, is_open = halves[pos]
                out.append((at, name, 0, parts_there, is_open, None, None, False, None, None, None, None, word, pos, half))
            todo += [(n, node, name, parts, level) for n in node.below]
            if len(out) >= 1 << 16:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def spread(batches):
        held, letters, before = [], 0, ""
        for batch in batches:
            for word in batch.column(0).to_pylist():
                if len(held) >= 5 * part and (len(held) >= 25 * part or word[:least] != before[:least]) or letters >= HELD_LETTERS:
                    yield from rows_of(held, left, _shared(before, word))
                    held, letters = [], 0
                if not held:
                    left = _shared(before, word)
                held.append(word)
                letters += len(word)
                before = word
        if held:
            yield from rows_of(held, left, 0)

    together = words.select("word").repartition(F.substring("word", 1, least)).sortWithinPartitions("word")
    return together.mapInArrow(spread, "level int, node long, next int, parts int, open boolean, label string, child long, child_open boolean, ends boolean, "
                                       "held long, sizes long, following string, word string, pos int, half long")


def trie(words, part=PART):
    """(edges, starts, ends): the trie's edges by level, the state of every word at its half, and the node of every word.

    Nodes are kept where words part, where one ends and where one has its half. An edge has its parent, the
    label, and the child with the number of its parts, whether a word ends there, whether it has one word only,
    the letters that follow and a bit for each length (modulo 64) of the words below. Levels count the kept nodes
    from the shortest half on, as no word has an edit above its half.
    """
    least = 1 + ((words.agg(F.min(F.length("word"))).first()[0] or 1) - 1) // 2
    rows = settle(_prefixes(words, least, part).sortWithinPartitions("level"))     # a level is read without the others' pages
    edge = ["level", F.col("node").alias("parent"), F.col("parts").alias("parent_parts"), "open", "label", "child", "ends", "held", "sizes", "following"]
    edges, starts = rows.filter("next > 0 AND NOT child_open").select(*edge), rows.filter("next = 0")
    if not rows.filter("child_open").isEmpty():
        opened = settle(rows.filter("child_open").select(*edge).groupBy("level", "parent", "open", "label", "child").agg(
            F.max("ends").alias("ends"), F.sum("held").alias("held"), F.bit_or("sizes").alias("sizes"),
            F.array_join(F.collect_set("following"), "").alias("following")))
        known = opened.select(F.col("child").alias("node"), F.ceil(F.col("held") / part).cast("int").alias("parts"))
        above = edges.filter("open").unionByName(opened.filter("parent IS NOT NULL").withColumn("parent_parts", F.lit(1)))
        above = settle(above.drop("parent_parts").join(known.toDF("parent", "parent_parts"), "parent"))
        halves = settle(starts.filter("open").drop("parts").join(known.toDF("half", "parts"), "half"))
        edges, starts = edges.filter("NOT open").unionByName(above), starts.filter("NOT open").unionByName(halves)
    salts = F.explode(F.sequence(F.lit(0), F.col("parent_parts") - 1))
    whole = edges.select("level", "parent", salts.alias("salt"), F.substring("label", 1, 1).alias("letter"), "label", "child",
                         F.ceil(F.col("held") / part).cast("int").alias("parts"), "ends", (F.col("held") == 1).alias("alone"), "sizes", "following")
    at_half = starts.select("word", "pos", F.col("half").alias("node"), "parts", F.lit(0).alias("edits"), F.lit(False).alias("ends"), "level")
    return whole, at_half, rows.filter("next = 0").select("node", F.col("word").alias("near"))


# --- the frontier --------------------------------------------------------------------

_METHOD = "spark.sql.codegen.hugeMethodLimit"
_AS_IT_IS, _MORE, _OTHER = 1, 2, 4      # how a word goes along a label: no edit, a letter more in the label, another letter
_NONE, _SAME_LENGTH, _LONGER = 0, 1, 2  # the edit a state has used: none, one to a word of its length, one to a longer word


def _letter(pos):
    """The word's letter number ``pos`` (from 0), '' behind its end."""
    return F.substring("word", pos + 1, F.lit(1))


def _alive(pos, letter):
    """Whether a word with its edit used can go on from the child with ``letter``, its letter number ``pos``."""
    return F.when(letter != "", F.contains("following", letter)).otherwise(F.col("ends") & (pos == F.length("word")))


def _edited(offset):
    """Whether the word goes along the label with one edit and can go on; labels of one letter need no comparison.

    Of two words with another letter at one place only the one with the smaller letter is followed.
    """
    size = F.length("label")
    part = F.substring("word", F.col("pos") + 1, size + offset)
    to = F.col("pos") + size + offset
    short, long = F.lit(True), (F.length(part) == size + offset) & (F.levenshtein(part, "label", 1) == 1)
    if offset == 0:
        short, long = (F.col("c0") != "") & (F.col("c0") < F.col("letter")), long & (part < F.col("label"))
    return F.when(size == 1, short & _alive(F.col("pos") + 1 + offset, F.col(f"c{1 + offset}"))).otherwise(_alive(to, _letter(to)) & long)


def _below(more):
    """Whether words with so many letters more than the state's stand below the child."""
    return F.expr(f"(shiftright(sizes, (length(word) + {more}) % 64) & 1L) = 1")


def advance(states, edges):
    """The states after the next level's edges. A state goes on while words of the length it needs are below.

    A task builds a hash table of its share of a level's edges, so states are not sorted.
    """
    lettered = (states.withColumns({"salt": F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), "c0": _letter(F.col("pos")), "c1": _letter(F.col("pos") + 1)})
                .withColumnRenamed("node", "parent").drop("parts", "ends"))
    on = ["parent", "salt"]
    met = lettered.alias("s").join(edges.hint("shuffle_hash").alias("e"), on).filter("edits = 0 OR c0 = letter")
    after = F.col("pos") + F.length("label")
    whole = F.substring("word", F.col("pos") + 1, F.length("label")) == F.col("label")
    # below a child with one word, a word without an edit finds itself only
    free = (F.when(~F.col("alone") & whole, _AS_IT_IS).otherwise(0) + F.when(_below(1) & _edited(-1), _MORE).otherwise(0)
            + F.when(_below(0) & _edited(0), _OTHER).otherwise(0))
    bound = F.when(_below("edits - 1") & whole & _alive(after, _letter(after)), _AS_IT_IS).otherwise(0)
    ways = F.when(F.col("edits") == _NONE, free).otherwise(bound)
    chosen = F.array(*[F.array(*[F.lit(b) for b in (_AS_IT_IS, _MORE, _OTHER) if b & mask]) for mask in range(1, 8)])
    moved = met.withColumn("ways", ways).filter("ways > 0").withColumn("way", F.explode(F.get(chosen, F.col("ways") - 1)))
    edited = F.when(F.col("way") == _AS_IT_IS, F.col("edits")).when(F.col("way") == _MORE, _LONGER).otherwise(_SAME_LENGTH)
    return moved.select("word", (after - F.when(F.col("way") == _MORE, 1).otherwise(0)).alias("pos"), F.col("child").alias("node"),
                        "parts", edited.alias("edits"), "ends")


def walk(words, part=PART):
    """(word, near): pairs whose one edit lies behind the half of ``word``; ``near`` has a letter more or a greater one."""
    spark = words.sparkSession
    before = spark.conf.get(_METHOD)
    spark.conf.set(_METHOD, "8000")     # a level's expressions are long; beyond this size the JVM would not compile them
    try:
        return _walked(words, part)
    finally:
        spark.conf.set(_METHOD, before)


def _walked(words, part):
    edges, starts, ends = trie(words, part)
    last = starts.agg(F.max("level")).first()[0]
    found, states, level = None, None, 0
    while last is not None:
        here = starts.filter(F.col("level") == level).drop("level")
        states = here if states is None else states.unionByName(here)
        states = settle(advance(states, edges.filter(F.col("level") == level).drop("level")))
        at_end = F.col("ends") & (F.col("edits") > _NONE) & (F.col("pos") == F.length("word"))
        ended = states.filter(at_end).select("word", "node")
        found = ended if found is None else found.unionByName(ended)
        states = states.filter(~at_end)
        level += 1
        if level > last and states.isEmpty():
            break
    if found is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    return found.join(ends.hint("shuffle_hash"), "node").filter(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def neighbours(words, part=PART):
    """(word, near): all pairs of words that differ by one letter more, less or another, both ways.

    One edit leaves the first or the second half of a word as it is, so the trie holds the words as they are and
    reversed, and both are walked with edits behind their half only. No state has an edit near the root, where
    nearly all letters follow one another. Every pair is walked from one of its words only.
    """
    found = walk(_sides(words), part)
    plain = lambda c: F.when(F.startswith(F.col(c), F.lit(_ONWARD)), F.substring(c, 2, 1 << 30)).otherwise(F.reverse(F.substring(c, 2, 1 << 30)))
    pairs = found.select(plain("word").alias("word"), plain("near").alias("near"))
    both = F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))))
    return pairs.select(both.alias("p")).select("p.*").repartition("word").dropDuplicates(["word", "near"])


def roots(forms):
    """(word, root): where the forms (word, form) of each word lead. A form occurs many times more often, so there is no circle."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        up = settle(at.join(forms.select(F.col("word").alias("root"), F.col("form").alias("up")), "root", "left"))
        at = up.select("word", F.coalesce("up", "root").alias("root"))
        if up.filter("up IS NOT NULL").isEmpty():
            return at


def variants(docs, doc_id="doc_id", text="text", letters=LETTERS, occurrences=OCCURRENCES, times=TIMES, odd=ODD, part=PART):
    """word, form, root, n, n_near and form_n of every word with enough letters and occurrences.

    A null text has no words, a null id counts as empty. Repeated rows count each. Of near words that occur
    equally often the first in code-point order is the form. Other columns are not read.
    """
    words = settle(counts(docs, doc_id, text, letters, odd).filter(F.col("n") >= occurrences))
    pairs = neighbours(words, part)
    pairs = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("shuffle_hash"), "near")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    known = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    known = known.withColumn("_form", F.when(F.col("form_n") >= times * F.col("n"), F.col("best.near")))
    known = settle(known.select("word", F.col("_form").alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(F.col("_form").isNotNull(), F.col("form_n")).alias("form_n")))
    leads = roots(known.filter("form IS NOT NULL").select("word", "form"))
    return known.join(leads, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
