"""Links between sets that meet in posting lists, without all pairs of a group of copies.

A posting is (gram, key, what the filter needs). In a few rounds every set is compared with a few neighbours
from its lists in random order, and components follow. Members of one component need no comparison then, and
all the other pairs are compared. What is not looked at is only links inside a component that is known already.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from campuswatt.llm.common import components, settle

TURNS = 3          # rounds of random neighbours before all remaining pairs
PART = 512         # postings of one n-gram that are put in order together
PARTNERS = 8       # pairs tried for a set in a round
RANGES = 32        # hash ranges of the suffix filter


def link(postings, sets, likely, numerator, denominator, turns=TURNS, few_grams=False):
    """(node, root) of all sets that links between similar pairs of ``postings`` connect.

    ``likely(a, b)`` is a filter on two postings of one gram; ``sets`` has key, n, grams (packed 64-bit hashes) and
    ranges (:func:`range_counts`). Sets of ``few_grams`` carry all of them into the last join, where a pair then
    comes up only at the smallest gram it shares.
    """
    known = None
    for turn in range(turns):
        mixed = _mixed(postings, known)
        if turn:    # a list that one component holds alone stays so: later rounds go on without it
            mixed = settle(mixed)
            postings = mixed.drop("comp", "held")
        known = _joined(known, settle(_verified(_neighbours(mixed, turn, likely), sets, numerator, denominator)))
    rest = _mixed(postings, known).drop("held").join(sets.select("key", "ranges"), "key")
    apart = F.expr("x.comp < y.comp") & likely("x", "y") & _closer("x", "y", numerator, denominator)
    if few_grams:
        rest = rest.join(rest.groupBy("key").agg(F.collect_list("gram").alias("mine")), "key")
        apart = apart & F.expr("gram = array_min(array_intersect(x.mine, y.mine))")
    pairs = (rest.alias("x").join(rest.alias("y"), "gram").filter(apart)
             .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct())
    return _joined(known, settle(_verified(pairs, sets, numerator, denominator)))


def range_counts(grams):
    """How many of the hashes fall into each of ``RANGES`` ranges."""
    return np.bincount((grams >> np.uint64(45)).astype(np.int64) % RANGES, minlength=RANGES).tolist()


def enough(a, b, overlap, numerator, denominator):
    """Whether an overlap would make two sets similar."""
    return overlap * (numerator + denominator) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * numerator


def _closer(a, b, numerator, denominator):
    """Suffix filter: a gram has its match in its own hash range, so the smaller counts bound the overlap."""
    bound = sum((F.least(F.col(f"{a}.ranges")[i], F.col(f"{b}.ranges")[i]) for i in range(RANGES)), F.lit(0))
    return enough(a, b, bound, numerator, denominator)


def _joined(known, links):
    """Components known so far, joined by further links between their members or new nodes."""
    if known is None:
        return settle(components(links))
    if links.isEmpty():
        return known
    at = lambda side: known.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
    between = (links.join(at("a"), "a", "left").join(at("b"), "b", "left")
               .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    merged = components(between).select(F.col("node").alias("root"), F.col("root").alias("up"))
    old = known.join(merged, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    new = merged.join(known.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("up").alias("root"))
    return settle(old.unionByName(new))


def _mixed(postings, known):
    """The postings of grams held by several components, with the component and the number of holders."""
    if known is None:
        named = postings.withColumn("comp", F.col("key"))
    else:
        roots = known.withColumnsRenamed({"node": "key", "root": "comp"})
        named = postings.join(roots, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = (named.groupBy("gram").agg(F.count("*").alias("held"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo < hi").select("gram", "held"))
    return named.join(mixed, "gram")


def _neighbours(named, turn, likely):
    """A few likely pairs for every set: its neighbours when each posting list is put in a random order.

    Long lists are dealt into parts first. Of a set's neighbours in all its lists the most frequent ones stay.
    """
    part = F.pmod(F.xxhash64("key", F.lit(turn)), F.ceil(F.col("held") / PART))
    near = W.partitionBy("gram", "part").orderBy(F.xxhash64("gram", "key", F.lit(-turn - 1)), "key")
    row = F.struct(*[c for c in named.columns if c not in ("gram", "held")])
    both = (named.withColumn("part", part).select("gram", row.alias("x"), F.lag(row).over(near).alias("y"))
            .filter(F.expr("x.comp <> y.comp") & likely("x", "y")))
    pairs = both.groupBy(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).agg(F.count("*").alias("shared"))
    best = W.partitionBy("a").orderBy(F.desc("shared"), "b")
    return pairs.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= PARTNERS).select("a", "b")


def _verified(pairs, sets, numerator, denominator):
    """Pairs (a, b) whose sets are similar enough."""
    def check(batches):
        for batch in batches:
            ok = []
            for na, nb, ga, gb in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                common = np.intersect1d(np.frombuffer(ga, "<u8"), np.frombuffer(gb, "<u8"), assume_unique=True).size
                ok.append((numerator + denominator) * common >= numerator * (na + nb))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ga", "gb")
            .mapInArrow(check, "a binary, b binary"))
