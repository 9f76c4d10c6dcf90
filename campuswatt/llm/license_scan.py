"""License scans as an exact set-similarity join of text blocks with notice templates.

A block of a template is any run of consecutive words, over line ends, of ``SPAN`` times the template's number of
different words; it matches if it holds at least 80 % of them. Words are ordered by how many texts of the whole
corpus that could match hold them, rarest first. A block that matches holds one of the first ``n - need + 1``
words of the template (prefix filter), its text has ``need`` of the words (length filter), and from the first
shared word on both sides have enough words left (positional filter). Blocks around every place of a prefix word
in what passes are verified word by word. Everything runs in DataFrame functions; the template table is a fixed
list, so its broadcast does not grow.
"""

from pyspark.sql import functions as F

from campuswatt.llm.common import row_key, settle

THRESHOLD = (80, 100)
SPAN = 2        # words of a block for each different word of the template

# Phrases of the base labels.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Wording of common notices.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met",
    "cc-notice": "licensed under cc by 4 0",
    "cc-nc-notice": "licensed under cc by nc 4 0",
    "cc0-notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-program-notice": "this program is free software you can redistribute it and or modify it under the terms of "
                          "the gnu general public license as published by the free software foundation",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files",
    "mit-line": "released under the mit license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "reserved-notice": "all rights reserved",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(lowered):
    """Words of a lowered text, in order."""
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def _places(words, phrase):
    """Word numbers where the phrase starts."""
    parts = phrase.split(" ")
    here = lambda i: _all([F.get(words, i + k) == p for k, p in enumerate(parts)])
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _need(n):
    num, den = THRESHOLD
    return -(-n * num // den)


def base_columns(texts):
    """Words, phrase places and base labels of every row of ``texts`` (lowered text in ``low``)."""
    none = F.array().cast("array<int>")
    # only texts that hold the letters of all words of a phrase are searched word by word
    found = {label: F.when((F.size("w") > 0) & _all([F.contains("low", F.lit(p)) for p in phrase.split(" ")]),
                           _places(F.col("w"), phrase)).otherwise(none) for label, phrase in PHRASES.items()}
    out = texts.withColumn("w", _words(F.col("low"))).withColumn("n_words", F.size("w").cast("bigint"))
    out = out.withColumns({f"_{label}": places for label, places in found.items()})
    places = F.concat(*[F.col(f"_{label}") for label in PHRASES])
    labels = F.array(*[F.when(F.size(f"_{label}") > 0, F.lit(label)) for label in sorted(PHRASES)])
    return (out.withColumn("_all", places).withColumns({
        "n_base": F.size("_all").cast("bigint"), "first_word": F.array_min("_all").cast("bigint"),
        "last_word": F.array_max("_all").cast("bigint"), "_base": F.array_compact(labels)})
        .drop("w", "_all", *[f"_{label}" for label in PHRASES]))


def _template_sets():
    return {label: sorted(set(text.split(" "))) for label, text in TEMPLATES.items()}


def likely(texts):
    """(row, low, hits) of every text that has enough words of some template, wherever they stand; one row each."""
    sets = _template_sets()
    vocabulary = sorted({w for ws in sets.values() for w in ws})
    hit = texts.select("row", "low", F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), _words(F.col("low"))).alias("hits"))
    enough = [F.size(F.array_intersect("hits", F.array(*[F.lit(w) for w in ws]))) >= _need(len(ws)) for ws in sets.values()]
    either = enough[0]
    for one in enough[1:]:
        either = either | one
    return hit.filter((F.size("hits") >= min(_need(len(ws)) for ws in sets.values())) & either).dropDuplicates(["row"])


def _best_block(words, place, template, span):
    """Most different words of the template in one block that holds the word at ``place``."""
    first = F.greatest(place - span + 1, F.lit(0))
    near = F.slice(words, first + 1, place + span - first)
    held = F.filter(F.transform(near, lambda x, i: F.struct(i.alias("i"), F.when(F.array_contains(template, x), x).alias("x"))),
                    lambda s: s["x"].isNotNull())

    def from_word(start):
        inside = F.filter(held, lambda s: (s["i"] >= start["i"]) & (s["i"] < start["i"] + span))
        return F.size(F.array_distinct(F.transform(inside, lambda s: s["x"])))

    return F.array_max(F.transform(held, from_word))


def matches(texts):
    """(row, label, share) of every row and template with a matching block; share is the best containment."""
    sets = _template_sets()
    found = settle(likely(texts))
    counts = {r.w: r["count"] for r in found.select(F.explode("hits").alias("w")).groupBy("w").count().collect()}   # a row a template word
    order = sorted({w for ws in sets.values() for w in ws}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = []
    for label, ws in sets.items():
        ordered = sorted(ws, key=rank.get)
        rare = ordered[:len(ws) - _need(len(ws)) + 1]
        prefixes += [(w, label, i, len(ws), _need(len(ws)), ordered) for i, w in enumerate(rare)]
    prefixes = texts.sparkSession.createDataFrame(
        prefixes, "word string, label string, at int, n int, need int, words array<string>")
    ordered = found.withColumn("hits", F.array_intersect(F.array(*[F.lit(w) for w in order]), "hits"))
    candidates = (ordered.select("row", "low", "hits", F.posexplode("hits").alias("place", "word"))
                  .join(F.broadcast(prefixes), "word")
                  .filter("size(hits) >= need AND 1 + least(n - at - 1, size(hits) - place - 1) >= need")
                  .filter("size(array_intersect(hits, words)) >= need"))
    # the blocks around every place of a prefix word are verified, inside one row
    places = F.filter(F.transform("text", lambda x, i: F.when(x == F.col("word"), i)), lambda i: i.isNotNull())
    best = F.array_max(F.transform(places, lambda at: _best_block(F.col("text"), at, F.col("words"), F.col("n") * SPAN)))
    verified = candidates.withColumn("text", _words(F.col("low"))).select("row", "label", "n", "need", best.alias("common"))
    return verified.filter("common >= need").groupBy("row", "label").agg(F.max(F.col("common") / F.col("n")).alias("share"))


def scan(docs, doc_id="doc_id", text="text"):
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    The score is the best containment of a template, 1 with a base phrase, 0 without either. A null text is
    empty. Rows equal in id and text get equal results. Other columns are not read.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    texts = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"), low.alias("low"))
    own = (matches(texts.select("row", "low")).groupBy("row")
           .agg(F.collect_set("label").alias("own"), F.max("share").alias("share")))
    none = F.array().cast("array<string>")
    joined = base_columns(texts).drop("low").join(own, "row", "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "_base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("_base", F.coalesce("own", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
