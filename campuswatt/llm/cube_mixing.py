"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target size. All its documents are taken the whole number of times that fits, and the
rest is a probability between 0 and 1, equal for all its documents. The cube method turns these into 0 or 1
while the sums of sizes and of documents stay as they are: it takes as many undecided documents as there are
constraints and one more, and moves their probabilities along the null space of the constraints until one
reaches 0 or 1. This runs block by block; what a block cannot decide, two documents at most, moves on to
blocks of such leftovers, until a source has one block and a landing of a few documents.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from campuswatt.llm import text as X
from campuswatt.llm.common import own_name, settle, with_columns
from campuswatt.operators.ordering import global_position

WEIGHTS = (5, 2, 1)
SHARE, AT_MOST = 1.5, 2.0
BLOCK = 4096
LANDING = 12                   # documents the landing decides together, besides two left over
EDGE = 1e-9


def word_counts(docs, columns, text):
    """The columns and ``size``, the number of words of the text."""
    schema = docs.select(*columns).schema
    names = schema.names

    def read(batches):
        for batch in batches:
            for first, offsets, data in X.chunks(batch.column(len(names))):
                counts = X.spans(data, offsets)[2].astype(np.int64)
                rows = batch.slice(first, len(counts))
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in range(len(names))] + [pa.array(counts)],
                                                 names=[*names, "size"])

    return docs.select(*columns, F.col(text).alias("_text")).mapInArrow(read, with_columns(schema, size="long"))


def targets(sizes, weights=WEIGHTS, share=SHARE, at_most=AT_MOST):
    """source, n, source_size and target of every source of ``sizes`` (source, size).

    Sources in code point order, null last, take the weights in turn. A target stops at ``at_most`` times the
    size of its source, and what is left over goes to the others by weight until none is above: the common
    level rises from step to step, and each step is one sum over the sources.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    ranked = global_position(sources, [F.col("source").isNull(), F.col("source")], into="_pos")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_pos") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("source", "n", "source_size", weight.alias("w"), (F.col("source_size") * at_most).alias("most")))
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("w") * level
        row = ranked.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("most"),
                         F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("w")).first()
        if row.n == capped or not row.w:
            break
        capped, level = row.n, (total - row.most) / row.w
    return ranked.select("source", "n", "source_size", F.least("most", F.col("w") * level).alias("target"))


def flight(sizes, chances, rng):
    """Move probabilities until two documents at most are open; sums of sizes and of documents are kept.

    Large documents go first, so what stays open is small as a rule. Returns the new probabilities.
    """
    p, size = chances.astype(float).tolist(), sizes.tolist()
    queue = [i for i in np.argsort(-sizes, kind="stable").tolist() if EDGE < p[i] < 1 - EDGE]
    draws = rng.random(len(queue) + 1).tolist()
    active, nxt = queue[:3], 3
    while len(active) == 3:
        a, b, c = active
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])     # neither sum moves along u
        if u == (0, 0, 0):
            u = (1, -1, 0)
        scale = max(abs(x) for x in u)
        u = [x / scale for x in u]
        up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(active, u) if x)
        down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(active, u) if x)
        step = up if draws.pop() * (up + down) < down else -down
        still = []
        for i, x in zip(active, u):
            p[i] += step * x
            if EDGE < p[i] < 1 - EDGE:
                still.append(i)
            else:
                p[i] = round(p[i])
        take = 3 - len(still)
        active = still + queue[nxt:nxt + take]
        nxt += take
    return np.array(p, dtype=float)


def landing(sizes, chances):
    """Decide the last few: of all ways the one closest in size, then in documents."""
    is_open = np.flatnonzero((chances > EDGE) & (chances < 1 - EDGE))
    if not len(is_open):
        return chances
    ways = (np.arange(1 << len(is_open))[:, None] >> np.arange(len(is_open))) & 1
    size, p = sizes[is_open].astype(float), chances[is_open]
    miss = np.abs(ways @ size - size @ p) + np.abs(ways.sum(axis=1) - p.sum()) * max(size.mean(), 1.0) / 100
    out = chances.copy()
    out[is_open] = ways[np.argmin(miss)]
    return out


def decide(sizes, chances, rng, last):
    """New probabilities of a block: two are open at most, none in the last block of a source.

    The last block keeps some documents of all sizes out of the flight, so that its landing has a choice.
    """
    if not last:
        return flight(sizes, chances, rng)
    by_size = np.argsort(-sizes, kind="stable")
    spared = by_size[np.unique(np.linspace(0, len(sizes) - 1, min(LANDING, len(sizes))).astype(int))]
    flying = np.ones(len(sizes), dtype=bool)
    flying[spared] = False
    out = chances.astype(float).copy()
    out[flying] = flight(sizes[flying], chances[flying], rng)
    return landing(sizes, out)


def _decide(kinds):
    def run(table):
        table = table.sort_by([("size", "descending"), ("tag", "ascending")])     # the same order in every run
        tags = table.column("tag").to_numpy().view(np.uint64)
        rng = np.random.default_rng(int(X.fold(tags[:64])))
        p = decide(table.column("size").to_numpy(), table.column("p").to_numpy(), rng, table.column("blocks")[0].as_py() == 1)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p)).select(kinds)

    return run


def copies(docs, columns=("doc_id",), source="source", text="text", weights=WEIGHTS, share=SHARE, at_most=AT_MOST, block=BLOCK):
    """The columns, size, source_size, target and copies (how often the mix takes it) of every row.

    A null text has size 0, a null source is one source. Equal rows are decided one by one; which of them is
    taken is open, how many are is not. Reruns agree: blocks, order and draws follow from the rows alone.
    """
    names = [f"c{i}" for i in range(len(columns))]
    picked = docs.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], F.col(source).alias("source"), F.col(text).alias("_body"))
    rows = settle(word_counts(picked, [*names, "source", F.xxhash64(*names, "source", "_body").alias("tag")], "_body"))
    aims = settle(targets(rows, weights, share, at_most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + EDGE)
    joined = (rows.join(aims, rows.source.eqNullSafe(aims.source)).drop(aims.source)
              .withColumn("whole", whole.cast("bigint")).withColumn("p", F.greatest(rate - whole, F.lit(0.0))))
    state = joined.withColumn("blocks", F.ceil(F.col("n") / block).cast("bigint"))
    kinds = state.columns
    done = None
    while True:
        spot = F.pmod(F.xxhash64("tag", F.lit(len(kinds))), F.col("blocks"))
        state = settle(state.withColumn("spot", spot).groupBy("source", "spot")
                       .applyInArrow(_decide(kinds), state.schema))
        is_open = (F.col("p") > EDGE) & (F.col("p") < 1 - EDGE)
        closed = state.filter(~is_open)
        done = closed if done is None else done.unionByName(closed)
        left = state.filter(is_open)
        counts = left.groupBy("source").agg(F.count("*").alias("_left"))
        if counts.isEmpty():
            break
        state = (left.join(counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                 .withColumn("blocks", F.ceil(F.col("_left") / block).cast("bigint")).select(*kinds))
    return done.select(*[F.col(n).alias(c) for c, n in zip(columns, names)], "size", "source_size", "target",
                       (F.col("whole") + F.round("p").cast("bigint")).alias("copies"), "source", "tag")


def mix(docs, doc_id="doc_id", source="source", text="text", **how):
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row."""
    out = copies(docs, (doc_id,), source, text, **how)
    return out.select(F.col(doc_id).alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs, doc_id="doc_id", source="source", text="text", **how):
    """The rows of the mix with all columns of ``docs``, each as often as it is taken."""
    decided = copies(docs, (doc_id,), source, text, **how)
    # equal rows share a tag; their copies add up and fall to the rows of the tag evenly
    tag, copies_, rows_, nth_, times, each = (own_name(docs, c) for c in ("tag", "copies", "rows", "nth", "times", "each"))
    per_tag = decided.groupBy(F.col("tag").alias(tag)).agg(F.sum("copies").alias(copies_), F.count("*").alias(rows_)).filter(F.col(copies_) > 0)
    nth = F.row_number().over(W.partitionBy(tag).orderBy(F.lit(0)))
    rows = docs.withColumn(tag, F.xxhash64(doc_id, source, text)).join(per_tag, tag).withColumn(nth_, nth)
    rows = rows.withColumn(times, F.floor(F.col(copies_) / F.col(rows_)) + (F.col(nth_) <= F.col(copies_) % F.col(rows_)).cast("int"))
    return rows.withColumn(each, F.explode(F.array_repeat(F.lit(0), F.col(times).cast("int")))).select(*docs.columns)
