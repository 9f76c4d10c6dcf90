"""Quality rules as a short-circuit cascade: the rule that rejects most per cost runs first.

Cost and rejections of every rule are measured on a bounded sample; then each block of texts goes through
the rules in the order of rejections per cost, and a rule sees only what the rules before it left. A text
is kept if no rule rejects it, so the order decides how long it takes, never what is kept.
"""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm import text as X

RUN, MIN_WORDS, REPEATED = 5, 10, 20     # words of a run; words of a text; per cent of words in repeated runs
SAMPLE_ROWS = 2000
SYMBOLS = np.zeros(256, dtype=np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True
_FIRST_BYTE = np.ones(256, dtype=bool)     # all but the later bytes of a character
_FIRST_BYTE[0x80:0xC0] = False
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[ord("A"):ord("Z") + 1] = 1
_LETTER = _UPPER.copy()
_LETTER[ord("a"):ord("z") + 1] = 1


class Block:
    """Some whole texts. A measure is taken of the texts that a rule asks it of, and of each text once."""

    def __init__(self, offsets, data):
        self.offsets, self.data = offsets, data
        self._values, self._known = {}, {}

    def __len__(self):
        return len(self.offsets) - 1

    def _part(self, at):
        """The texts numbered ``at`` as a block of their own."""
        if len(at) == len(self):
            return self
        sizes = np.diff(self.offsets)[at]
        data = np.concatenate([self.data[self.offsets[i]:self.offsets[i + 1]] for i in at] or [self.data[:0]])
        return Block(np.concatenate([[0], np.cumsum(sizes)]), data)

    def measure(self, name, at=None):
        """The measure of the texts numbered ``at`` (of all)."""
        at = np.arange(len(self)) if at is None else at
        if name not in self._values:
            self._values[name] = np.zeros(len(self), dtype=np.int64)
            self._known[name] = np.zeros(len(self), dtype=bool)
        lacking = at[~self._known[name][at]]
        if len(lacking):
            part = self._part(lacking)
            for extra in sorted(TOGETHER.get(name, {name})):
                if extra != name and extra in self._values and self._known[extra][lacking].all():
                    continue
                values = MEASURES[extra](part)
                self._values.setdefault(extra, np.zeros(len(self), dtype=np.int64))[lacking] = values
                self._known.setdefault(extra, np.zeros(len(self), dtype=bool))[lacking] = True
        return self._values[name][at]

    def words(self):
        if not hasattr(self, "_words"):
            self._words = X.spans(self.data, self.offsets)
        return self._words

    def per_text(self, values):
        """Sums of a value per byte."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def _n_words(block):
    return block.words()[2]


def _word_chars(block):
    return block.per_text(_FIRST_BYTE[block.data] & ~X.BLANK[block.data])


def _n_symbols(block):
    return block.per_text(SYMBOLS[block.data])


def _line_spans(block):
    """Lines with a word: start, end, lines per text."""
    starts, ends, per = X.spans(block.data, block.offsets, _NEWLINE)
    inked = np.concatenate([[0], np.cumsum(~X.BLANK[block.data])])
    with_word = inked[ends] > inked[starts]
    text = np.repeat(np.arange(len(block)), per)[with_word]
    return starts[with_word], ends[with_word], text


def _n_lines(block):
    return np.bincount(_line_spans(block)[2], minlength=len(block))


def _n_dup_lines(block):
    starts, ends, text = _line_spans(block)
    lines = X.hashes(block.data, starts, ends)
    order = np.lexsort((lines, text))
    lines, text = lines[order], text[order]
    again = (lines[1:] == lines[:-1]) & (text[1:] == text[:-1])
    return np.bincount(text[1:][again], minlength=len(block))


def _n_repeat_words(block):
    starts, ends, per = block.words()
    grams = X.windows(X.hashes(block.data, starts, ends), RUN)
    cover, at, out = np.zeros(len(starts) + 1, dtype=np.int64), 0, np.zeros(len(block), dtype=np.int64)
    for i, n in enumerate(per.tolist()):
        if n > RUN:
            own = grams[at:at + n - RUN + 1]
            _, back, found = np.unique(own, return_inverse=True, return_counts=True)
            twice = found[back] > 1
            if twice.any():
                cover[:n + 1] = 0
                cover[:len(own)] += twice
                cover[RUN:len(own) + RUN] -= twice
                out[i] = np.count_nonzero(np.cumsum(cover[:n]))
        at += n
    return out


def _n_upper(block):
    return block.per_text(_UPPER[block.data])


def _n_letters(block):
    return block.per_text(_LETTER[block.data])


#: What rules can ask of a block, one number a text.
MEASURES = {"n_words": _n_words, "word_chars": _word_chars, "n_symbols": _n_symbols, "n_lines": _n_lines,
            "n_dup_lines": _n_dup_lines, "n_repeat_words": _n_repeat_words, "n_upper": _n_upper, "n_letters": _n_letters}

#: Measures that come from one reading of the words are taken with one another.
TOGETHER = {"n_repeat_words": {"n_repeat_words", "n_words"}}


class Rule:
    """Marks texts to reject, from the measures it names. Whole numbers only, so that no rounding decides."""

    def __init__(self, rejects, *measures):
        self.rejects, self.measures = rejects, measures

    def __call__(self, block, at=None):
        return self.rejects(*(block.measure(m, at) for m in self.measures))


BASE = {
    "few_words": Rule(lambda n: n < MIN_WORDS, "n_words"),
    "repeated_words": Rule(lambda r, n: 100 * r > REPEATED * n, "n_repeat_words", "n_words"),
}

RULES = BASE | {
    "short_words": Rule(lambda c, n: c < 2 * n, "word_chars", "n_words"),
    "long_words": Rule(lambda c, n: c > 20 * n, "word_chars", "n_words"),
    "symbols": Rule(lambda s, n: 10 * s > 3 * n, "n_symbols", "n_words"),
    "dup_lines": Rule(lambda d, n: 10 * d > 5 * n, "n_dup_lines", "n_lines"),
    "capitals": Rule(lambda u, n: 10 * u > 6 * n, "n_upper", "n_letters"),
}


def profile(docs, text="text", rules=RULES, sample_rows=SAMPLE_ROWS):
    """Seconds of every measure and rejections of every rule on a random sample of about ``sample_rows`` rows.

    Returns ({measure: seconds}, {rule: rejected}). A measure is timed by itself, so a rule that needs what
    another rule has taken already is cheap after it.
    """
    measures = sorted({m for r in rules.values() for m in r.measures})
    names = [*measures, *rules]

    def run(batches):
        spent, rejected = np.zeros(len(names)), np.zeros(len(names), dtype=np.int64)
        for batch in batches:
            for _, offsets, data in X.chunks(batch.column(0)):
                for k, name in enumerate(measures):
                    block, began = Block(offsets, data), time.thread_time()
                    MEASURES[name](block)
                    spent[k] += time.thread_time() - began
                block = Block(offsets, data)
                for k, rule in enumerate(rules.values(), len(measures)):
                    rejected[k] += int(rule(block).sum())
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(spent), pa.array(rejected)], names=["name", "seconds", "rejected"])

    rows = docs.count()
    sample = docs.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / max(rows, 1)), seed=7)
    found = (sample.mapInArrow(run, "name string, seconds double, rejected long").groupBy("name")
             .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect())   # a row a rule and measure
    return {r.name: r.seconds for r in found if r.name in measures}, {r.name: r.rejected for r in found if r.name in rules}


def in_order(rules, costs):
    """Rules by rejections per second, most first; what a chosen rule has measured costs the next ones nothing."""
    seconds, rejected = costs
    order, taken, left = [], set(), set(rules)
    while left:
        def gain(name):
            cost = sum(seconds.get(m, 0.0) for m in rules[name].measures if m not in taken)
            return (rejected.get(name, 0) + 0.5) / (cost + 1e-6)

        best = max(sorted(left), key=gain)
        order.append(best)
        left.remove(best)
        for m in rules[best].measures:
            taken |= TOGETHER.get(m, {m})
    return order


def passes(block, rules, order):
    """Numbers of the texts that no rule rejects; each rule runs on what the rules before it left."""
    kept = np.arange(len(block))
    for name in order:
        if not len(kept):
            break
        kept = kept[~rules[name](block, kept)]
    return kept


def assess(docs, doc_id="doc_id", text="text", rules=RULES, measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
           sample_rows=SAMPLE_ROWS):
    """doc_id, the measures, base_failed and kept of every row.

    The cascade runs first; then the measures asked for are taken of the texts that it did not need them of. A
    null text has no words, like an empty one, and fails. Repeated rows are judged one by one and alike.
    Other columns of ``docs`` are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    order = in_order(rules, profile(docs, text, rules, sample_rows))

    def run(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(1)):
                block = Block(offsets, data)
                kept = np.zeros(len(block), dtype=bool)
                kept[passes(block, rules, order)] = True      # what the cascade measured is not measured again below
                values = [block.measure(m) for m in measures]
                failed = np.zeros(len(block), dtype=bool)
                for rule in BASE.values():
                    failed |= rule(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(block)), *[pa.array(v.astype(np.int64)) for v in values],
                     pa.array(failed), pa.array(kept & ~failed)], names=["doc_id", *measures, "base_failed", "kept"])

    schema = ", ".join([f"doc_id {kind}", *[f"{m} long" for m in measures], "base_failed boolean", "kept boolean"])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def keep(docs, text="text", rules=RULES, sample_rows=SAMPLE_ROWS):
    """The rows of ``docs`` that pass, with all columns. Only the cascade runs: a rejected text costs no further rule."""
    order = in_order(rules, profile(docs, text, rules, sample_rows))
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(place)):
                kept = passes(Block(offsets, data), rules, order)
                if len(kept):
                    yield batch.take(pa.array(first + kept))

    return docs.mapInArrow(run, docs.schema)
