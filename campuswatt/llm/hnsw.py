"""Nearest neighbours by inner product: a navigable small-world graph per shard, shard results merged.

Equal vectors are one node that keeps its smallest ids, so a vector that very many rows share costs one node
and is still answered exactly. Vectors get one more component that makes all lengths equal; then the largest
inner product is the nearest vector, and graphs work for any lengths. A shard holds lengths within a factor of
``LENGTHS`` of each other, else one long vector would leave no difference between the others. A shard's graph is a few flat arrays in
one row of a table. Queries are dealt in blocks, each block meets each shard once, and the best of all shards
are scored again on the original vectors in double precision.
"""

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from campuswatt.llm.common import settle

NEAREST, EVERY = 20, 20
SHARD_VECTORS, QUERY_BLOCK = 8192, 2048
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 80, 160
LENGTHS, MOST_RANGES = 64, 1000


class Graph:
    """Nodes, their level, and neighbour arrays: level 0 has twice the links of the levels above."""

    def __init__(self, vectors, links=LINKS, width=BUILD_WIDTH):
        self.vectors, self.links, self.width = np.ascontiguousarray(vectors, dtype=np.float64), links, width
        n = len(vectors)
        rng = np.random.default_rng(n)
        self.levels = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(links)).astype(np.int8), 12)
        self.base = np.full((n, 3 * links), -1, dtype=np.int32)      # a third of the room is slack between prunings
        self.upper = {}
        self.counts = np.zeros(n, dtype=np.int32)
        self.seen, self.round, self.entry, self.top = np.zeros(n, dtype=np.int32), 0, -1, -1
        for i in range(n):
            self._insert(i)

    def pack(self):
        """Flat arrays: entry and top, levels, level 0, then the lists above as (level, node, neighbours)."""
        above = [np.array([level, node, *near, *[-1] * (self.links - len(near))], dtype=np.int32)
                 for (level, node), near in sorted(self.upper.items())]
        above = np.concatenate(above) if above else np.empty(0, np.int32)
        return (np.array([self.entry, self.top], np.int32).tobytes(), self.levels.tobytes(), self.base.tobytes(), above.tobytes())

    @classmethod
    def unpack(cls, vectors, head, levels, base, above, links=LINKS):
        self = cls.__new__(cls)
        self.vectors, self.links = np.ascontiguousarray(vectors, dtype=np.float64), links
        self.entry, self.top = np.frombuffer(head, np.int32).tolist()
        self.levels = np.frombuffer(levels, np.int8)
        self.base = np.frombuffer(base, np.int32).reshape(len(vectors), 3 * links)
        self.upper = {(row[0], row[1]): [x for x in row[2:] if x >= 0]
                      for row in np.frombuffer(above, np.int32).reshape(-1, links + 2).tolist()}
        self.seen, self.round = np.zeros(len(vectors), dtype=np.int32), 0
        return self

    def _near(self, node, level):
        if level:
            return np.array(self.upper.get((level, node), ()), dtype=np.int64)
        near = self.base[node]
        return near[near >= 0]

    def _walk(self, query, starts, width, level):
        """The ``width`` closest nodes a best-first walk finds: (closeness, node), closest first."""
        self.round += 1
        seen, mark, vectors = self.seen, self.round, self.vectors
        first = [(float(vectors[s] @ query), s) for s in starts]
        seen[list(starts)] = mark
        todo, best = [(-c, s) for c, s in first], list(first)
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            close, node = heapq.heappop(todo)
            if -close < best[0][0] and len(best) >= width:
                break
            near = self._near(node, level)
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            found = vectors[near] @ query
            if len(best) >= width:
                better = found > best[0][0]
                near, found = near[better], found[better]
            for c, s in zip(found.tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (c, s))
                elif c > best[0][0]:
                    heapq.heapreplace(best, (c, s))
                else:
                    continue
                heapq.heappush(todo, (-c, s))
        return sorted(best, reverse=True)

    def _choose(self, node_close, nodes, most):
        """Close nodes in different directions: one is left out if it is closer to a chosen one than to the node."""
        if len(nodes) <= most:
            return list(nodes)
        mutual = self.vectors[nodes] @ self.vectors[nodes].T
        chosen, blocked = [], np.full(len(nodes), -np.inf)
        for k in range(len(nodes)):
            if blocked[k] < node_close[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(blocked, mutual[k], out=blocked)
        if len(chosen) < most:      # fill up with the closest of the rest
            picked = set(chosen)
            chosen += [k for k in range(len(nodes)) if k not in picked][:most - len(chosen)]
        return [nodes[k] for k in chosen]

    def _insert(self, node):
        level, query = int(self.levels[node]), self.vectors[node]
        if self.entry < 0:
            self.entry, self.top = node, level
            return
        starts = [self.entry]
        for at in range(self.top, level, -1):
            starts = [self._walk(query, starts, 1, at)[0][1]]
        for at in range(min(level, self.top), -1, -1):
            found = self._walk(query, starts, self.width, at)
            starts = [s for _, s in found]
            near = self._choose(np.array([c for c, _ in found]), starts, self.links)
            if at:
                self.upper[(at, node)] = near
                for other in near:
                    back = [*self.upper.get((at, other), ()), node]
                    self.upper[(at, other)] = back if len(back) <= self.links else self._pruned(other, back, self.links)
            else:
                self.base[node, :len(near)] = near
                self.counts[node] = len(near)
                for other in near:
                    if self.counts[other] == 3 * self.links:
                        kept = self._pruned(other, self.base[other].tolist(), 2 * self.links)
                        self.base[other] = -1
                        self.base[other, :len(kept)] = kept
                        self.counts[other] = len(kept)
                    self.base[other, self.counts[other]] = node
                    self.counts[other] += 1
        if level > self.top:
            self.entry, self.top = node, level

    def _pruned(self, node, near, most):
        near = np.array(near)
        close = self.vectors[near] @ self.vectors[node]
        order = np.argsort(-close)
        return self._choose(close[order], near[order].tolist(), most)

    def search(self, query, width):
        """Nodes found for a query, closest first."""
        starts = [self.entry]
        for at in range(self.top, 0, -1):
            starts = [self._walk(query, starts, 1, at)[0][1]]
        return np.array([s for _, s in self._walk(query, starts, width, 0)])


# --- Spark -----------------------------------------------------------------------

def usable(table, vec_id="vec_id", embedding="embedding"):
    """vec_id, key, vec (doubles), dim and norm of the rows that take part.

    Null ids, null, empty or zero vectors and vectors with a null or non-finite component take no part. -0.0 is 0.0.
    """
    def read(batches):
        for batch in batches:
            rows = [[] for _ in range(5)]
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.as_py()
                if i is None or not v or None in v:
                    continue
                vec = np.array(v, dtype="<f8") + 0.0
                norm = float(vec @ vec)
                if np.isfinite(vec).all() and vec.any():
                    raw = vec.tobytes()
                    for out, value in zip(rows, (i, hashlib.blake2b(raw, digest_size=16).digest(), raw, len(vec), norm)):
                        out.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.float64())], names=["vec_id", "key", "vec", "dim", "norm"])

    return (table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
            .mapInArrow(read, "vec_id long, key binary, vec binary, dim long, norm double"))


def _matrix(column, dim):
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _lengthened(matrix, longest):
    longest = max(longest, 1e-300)      # squares of very short vectors are zero
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", matrix, matrix), 0.0))
    scale = 1.0 / np.sqrt(longest)
    return np.column_stack([matrix, rest]) * scale


_INDEX = "dim long, shard long, keys binary, vecs binary, head binary, levels binary, base binary, above binary"


def _build(table):
    table = table.sort_by("key")
    dim = table.column("dim")[0].as_py()
    matrix = _matrix(table.column("vec"), dim)
    graph = Graph(_lengthened(matrix, table.column("longest")[0].as_py()))
    values = [dim, table.column("shard")[0].as_py(), b"".join(table.column("key").to_pylist()), matrix.tobytes(), *graph.pack()]
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _INDEX.split(", ")])


def index(vectors, shard_vectors=SHARD_VECTORS):
    """Graphs of all distinct vectors (key, vec, dim, norm): one row per dimension and shard.

    Shards are parts of a range of lengths; the ranges go down from the longest vector of the dimension.
    """
    longest = vectors.groupBy("dim").agg(F.max("norm").alias("longest"))
    below = (F.log("longest") - F.log("norm")) / F.lit(2 * float(np.log(LENGTHS)))      # norms are squares
    last = F.lit(float(MOST_RANGES))
    ranged = vectors.join(longest, "dim").withColumn("range", F.floor(F.least(F.coalesce(below, last), last))).drop("longest")
    per_range = ranged.groupBy("dim", "range").agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / shard_vectors))
    dealt = ranged.join(per_range, ["dim", "range"]).withColumn("shard", part * (MOST_RANGES + 1) + F.col("range"))
    return settle(dealt.select("dim", "shard", "key", "vec", "longest").groupBy("dim", "shard").applyInArrow(_build, _INDEX))


def _search(nearest, width):
    def run(graphs, queries):
        if not graphs.num_rows or not queries.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.binary()), pa.array([], pa.binary()), pa.array([], pa.float64())],
                                        names=["query", "key", "score"])
        row = {c: graphs.column(c)[0].as_py() for c in graphs.column_names}
        matrix = np.frombuffer(row["vecs"], "<f8").reshape(-1, row["dim"])
        keys = np.frombuffer(row["keys"], "V16")
        longest = float(np.einsum("ij,ij->i", matrix, matrix).max())
        graph = Graph.unpack(_lengthened(matrix, longest), row["head"], row["levels"], row["base"], row["above"])
        wanted = _matrix(queries.column("vec"), row["dim"])
        out = [[], [], []]
        for name, query in zip(queries.column("key").to_pylist(), wanted):
            unit = np.append(query / np.sqrt(query @ query), 0.0)
            found = graph.search(unit, width)
            score = matrix[found] @ query
            best = np.argsort(-score, kind="stable")[:nearest]
            out[0] += [name] * len(best)
            out[1] += [k.tobytes() for k in keys[found[best]]]
            out[2] += score[best].tolist()
        return pa.Table.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.float64())],
                                    names=["query", "key", "score"])

    return run


def search(graphs, queries, nearest, width=SEARCH_WIDTH, query_block=QUERY_BLOCK):
    """(query, key, score): the ``nearest`` closest of each shard for every query (key, vec, dim).

    Blocks of queries meet shards one by one, so a task holds one shard and one block.
    """
    count = queries.count()
    blocks = max(1, -(-count // query_block))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = graphs.withColumn("block", every)
    shards = graphs.select(F.col("dim").alias("to_dim"), F.col("shard").alias("to_shard"))
    right = (queries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
             .join(shards, F.col("dim") == F.col("to_dim")).select("to_dim", "to_shard", "block", "key", "vec"))
    return left.groupBy("dim", "shard", "block").cogroup(right.groupBy("to_dim", "to_shard", "block")).applyInArrow(
        _search(nearest, width), "query binary, key binary, score double")


def neighbours(table, vec_id="vec_id", embedding="embedding", nearest=NEAREST, every=EVERY):
    """query_id, rank, vec_id and score of the nearest rows of every row whose vec_id ``every`` divides.

    Other rows with the query's vector are candidates, its own row is not; rows that repeat both vec_id and vector
    count once. Vectors are compared with those of their own dimension. Ties go to the smaller vec_id.
    """
    rows = settle(usable(table, vec_id, embedding))
    rn = F.row_number().over(W.partitionBy("key").orderBy("vec_id"))
    ids = rows.select("key", "vec_id").distinct().withColumn("_rn", rn).filter(F.col("_rn") <= nearest + 1).drop("_rn")
    ids = settle(ids)      # enough of each vector's ids for any answer
    vectors = settle(rows.groupBy("key").agg(F.first("vec").alias("vec"), F.first("dim").alias("dim"), F.first("norm").alias("norm")))
    asked = settle(rows.filter(F.col("vec_id") % every == 0).select("key", "vec_id").distinct())
    queries = vectors.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vec", "dim")
    found = search(index(vectors), settle(queries), nearest + 1)
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = (found.join(ids, "key").withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= nearest + 1)
            .select(F.col("query").alias("key"), "vec_id", "score"))
    rank = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return (asked.withColumnRenamed("vec_id", "query_id").join(best, "key").filter("query_id <> vec_id")
            .withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score"))
