"""Clustering around centroids in whole numbers, with bounds that spare most distances.

Each vector remembers its nearest and second-nearest centroid, an upper bound of the distance to the first and
a lower bound of the distance to all others. When centroids move, the bounds move with them; while the upper
bound lies below the lower one (or below half the way from the first centroid to the next), nothing is computed.
Otherwise both remembered centroids are measured, the scan starts from the closer one, and its neighbours come
in order of their distance. Only centroids within the distance to the start plus the distance to the second
nearest so far can matter, so the ball shrinks whenever a closer one is found. Bounds are floating point with a
margin; what they leave is compared in whole numbers, so ties and results are exact.

Vectors lie in blocks of rows. A round reads the blocks and writes them with their new state and sums beside the
old ones, two folders in turn; only the sums of each centroid reach the driver, whatever the input.
"""

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm.common import settle
from campuswatt.session import checkpoint_dir

SCALE, CLUSTERS, ROUNDS, SEED, COMPONENTS = 1024, 8, 10, 3, 64
BLOCK = 2048              # vectors of a block
BATCH_BLOCKS = 16         # blocks that go between Spark and Python at a time
PLAIN = 1 << 26           # below it, squared distances fit 64 bits
LONG = (1 << 63) - 1
LIMB = 32                 # sums travel in limbs of so many bits
MARGIN = 1e-9             # bounds give way by this share, far more than their rounding

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SUMS = "array<struct<cluster:int,limb:int,n:bigint,total:array<bigint>>>"
_PARTS = ["nearest binary", "second binary", "upper binary", "lower binary", f"sums {_SUMS}"]


def usable(table, components=COMPONENTS, vec_id="vec_id", embedding="embedding"):
    """vec_id and x (doubles) of the rows with exactly so many components, none null or non-finite."""
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter((F.size("x") == components) & finite)


def whole(x, scale=SCALE):
    """floor(scale * x) of doubles (scale a power of 2): 16 or 32 bits where they do, Python integers beyond."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    most = np.abs(y).max(initial=0)
    if most < PLAIN:
        return y.astype("<i2" if most < 1 << 15 else "<i4")
    exact = [math.floor(v) if math.isfinite(v) else int(u) * scale for u, v in zip(x.ravel().tolist(), y.ravel().tolist())]
    return np.array(exact, dtype=object).reshape(x.shape)


class Centroids:
    """Centroids of one round, the distances between them and how far they moved since the last."""

    def __init__(self, rows, old=None):
        self.rows = rows
        self.k = len(rows)
        self.plain = all(abs(v) < PLAIN for r in rows for v in r)
        if self.plain:
            self.matrix = np.array(rows, dtype=np.int64)
            apart = self.matrix[:, None, :] - self.matrix[None, :, :]
            self.gaps = np.sqrt((apart * apart).sum(axis=2))
            away = self.gaps + np.diag(np.full(self.k, np.inf))
            self.order = np.argsort(away, axis=1, kind="stable")[:, :max(self.k - 1, 1)]
            self.half = away.min(axis=1) / 2 * (1 - MARGIN)
        self.moves = None
        if old is not None and self.plain and all(abs(v) < PLAIN for r in old for v in r):
            step = self.matrix - np.array(old, dtype=np.int64)
            self.moves = np.sqrt((step * step).sum(axis=1)) * (1 + MARGIN)
            self.others = np.array([np.delete(self.moves, i).max(initial=0.0) for i in range(self.k)])

    def distance(self, x, at):
        """Squared distances of vectors to the centroids numbered ``at``, in whole numbers."""
        apart = x.astype(np.int64) - self.matrix[at]
        return np.einsum("ij,ij->i", apart, apart)

    def scan(self, x):
        """Nearest and second-nearest centroid of every vector among all, and their squared distances."""
        far = np.full(len(x), LONG, dtype=np.int64)
        best = [np.zeros(len(x), np.int32), far, np.full(len(x), -1, np.int32), far.copy()]
        for c in range(self.k):
            _take(best, np.arange(len(x)), c, self.distance(x, c))
        return best

    def shallot(self, x, nearest, second, upper, lower):
        """The state of every vector after the centroids moved."""
        if self.k == 1:
            return nearest, second, upper, lower
        upper, lower = upper + self.moves[nearest], lower * (1 - MARGIN) - self.others[nearest]
        open_ = np.flatnonzero(upper * (1 + MARGIN) >= np.maximum(lower, self.half[nearest]))
        first = self.distance(x[open_], nearest[open_])
        upper[open_] = np.sqrt(first)
        still = upper[open_] * (1 + MARGIN) >= np.maximum(lower[open_], self.half[nearest[open_]])
        open_, first = open_[still], first[still]
        if len(open_):
            v, a, b = x[open_], nearest[open_], second[open_]
            other = self.distance(v, b)
            swap = (other < first) | ((other == first) & (b < a))
            start, known = np.where(swap, b, a), np.where(swap, a, b)
            best = [start.copy(), np.where(swap, other, first), known.copy(), np.where(swap, first, other)]
            way = np.sqrt(best[1])
            inside = np.arange(len(open_))
            for j in range(self.k - 1):
                c = self.order[start[inside], j]
                ball = (way[inside] + np.sqrt(best[3][inside])) * (1 + MARGIN)
                within = self.gaps[start[inside], c] * (1 - MARGIN) <= ball
                inside, c = inside[within], c[within]
                if not len(inside):
                    break
                fresh = c != known[inside]
                at, c = inside[fresh], c[fresh]
                if len(at):
                    _take(best, at, c, self.distance(v[at], c))
            nearest, second = nearest.copy(), second.copy()
            nearest[open_], second[open_] = best[0], best[2]
            upper[open_], lower[open_] = np.sqrt(best[1]), np.sqrt(best[3])
        return nearest, second, upper, lower

    def exact(self, x):
        """Nearest centroid and squared distance of every vector in integers of any size."""
        rows = [[int(v) for v in r] for r in self.rows]
        best = [min((sum((p - q) ** 2 for p, q in zip(v, r)), c) for c, r in enumerate(rows)) for v in x.tolist()]
        return np.array([c for _, c in best], dtype=np.int32), [d for d, _ in best]


def _take(best, at, c, found):
    """Hold a measured centroid against the two best so far; ties go to the smaller number."""
    a, da, b, db = (part[at] for part in best)
    c = np.broadcast_to(np.asarray(c, dtype=np.int32), len(at))
    closer = (found < da) | ((found == da) & (c < a))
    next_ = ~closer & ((found < db) | ((found == db) & (c < b)))
    best[2][at], best[3][at] = np.where(closer, a, np.where(next_, c, b)), np.where(closer, da, np.where(next_, found, db))
    best[0][at], best[1][at] = np.where(closer, c, a), np.where(closer, found, da)


def _limbs(value):
    """A whole number in limbs, the lowest first; only the last is signed."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _block_sums(x, nearest, k):
    """Number and sum of the vectors of each centroid, in limbs."""
    out = []
    for c in range(k):
        mine = x[nearest == c]
        if len(mine):
            total = mine.sum(axis=0, dtype=object if x.dtype == object else np.int64).tolist()
            parts = [_limbs(int(v)) for v in total]
            for limb in range(max(map(len, parts))):
                out.append({"cluster": c, "limb": limb, "n": len(mine) if limb == 0 else 0,
                            "total": [p[limb] if limb < len(p) else 0 for p in parts]})
    return out


def _matrix(raw, width, dim, scale):
    """A block's vectors: packed integers of 2 or 4 bytes, or doubles where these are too small."""
    if width == 8:
        return whole(np.frombuffer(raw, "<f8").reshape(-1, dim), scale)
    return np.frombuffer(raw, f"<i{width}").reshape(-1, dim)


def blocks(rows, dim, scale=SCALE):
    """One row a block: ids, width of a component in bytes, and the packed components."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                y = whole(x, scale)
                width = 8 if y.dtype == object else y.dtype.itemsize
                ids = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([width], pa.int32()), pa.array([(x if width == 8 else y).tobytes()], pa.binary())],
                                                 names=["ids", "width", "x"])

    return rows.mapInArrow(run, f"ids array<{kind}>, width int, x binary")


def _assigned(table, centroids, dim, scale):
    """The blocks with the state of their vectors around ``centroids``, and their sums."""
    stateful = "nearest" in table.columns and centroids.moves is not None
    kind = table.schema["ids"].dataType.simpleString()
    names = ["ids", "width", "x", "nearest", "second", "upper", "lower", "sums"]
    schema = ", ".join([f"ids {kind}", "width int", "x binary", *_PARTS])

    def run(batches):
        for batch in batches:
            rows = {c: batch.column(c) for c in batch.schema.names}
            out = [[] for _ in range(5)]
            for i, (width, raw) in enumerate(zip(rows["width"].to_pylist(), rows["x"].to_pylist())):
                x = _matrix(raw, width, dim, scale)
                if width == 8 or not centroids.plain:
                    nearest, _ = centroids.exact(x)
                    state = nearest, np.zeros(len(x), np.int32), np.full(len(x), np.inf), np.zeros(len(x))
                elif stateful:
                    kinds = (("nearest", "<i4"), ("second", "<i4"), ("upper", "<f8"), ("lower", "<f8"))
                    held = [np.frombuffer(rows[c][i].as_py(), kind) for c, kind in kinds]
                    # a state without bounds is of a round in integers of any size
                    fresh = centroids.k > 1 and bool(np.isinf(held[2]).any())
                    state = _bounded(centroids.scan(x)) if fresh else centroids.shallot(x, *held)
                else:
                    state = _bounded(centroids.scan(x))
                for part, values in zip(out, state):
                    part.append(values.tobytes())
                out[4].append(_block_sums(x, state[0], centroids.k))
            sums = pa.array(out[4], pa.list_(pa.struct([("cluster", pa.int32()), ("limb", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])))
            yield pa.RecordBatch.from_arrays([rows["ids"], rows["width"], rows["x"], *[pa.array(p, pa.binary()) for p in out[:4]], sums], names=names)

    return table.select(*(names[:7] if stateful else names[:3])).mapInArrow(run, schema)


def _bounded(best):
    return best[0], best[2], np.sqrt(best[1]), np.sqrt(best[3].astype(np.float64))


def _means(table, centroids, dim):
    """Componentwise floor of the mean of every centroid's vectors; a centroid without vectors stays."""
    part = table.select(F.explode("sums").alias("s")).select("s.*")
    found = part.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(dim)]).collect()
    total, count = {}, {}
    for r in found:      # a row a centroid and limb
        at = total.setdefault(r.cluster, [0] * dim)
        for i in range(dim):
            at[i] += r[f"t{i}"] << (LIMB * r.limb)
        count[r.cluster] = count.get(r.cluster, 0) + r.n
    return [tuple(t // count[c] for t in total[c]) if c in total else row for c, row in enumerate(centroids)]


def starts(rows, clusters=CLUSTERS, seed=SEED, scale=SCALE):
    """The first centroids: the vectors with the smallest SHA-256 of ``seed:vec_id``, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(name.cast("binary"), 256).alias("h"), "x").orderBy("h", "x").limit(clusters).collect()
    return [tuple(int(v) for v in whole(np.array([r.x]), scale)[0]) for r in first]


def clusters(table, components=COMPONENTS, number=CLUSTERS, rounds=ROUNDS, seed=SEED, scale=SCALE, vec_id="vec_id", embedding="embedding"):
    """(rows, centroids): vec_id, cluster and squared distance of every vector that takes part, and the centroids.

    Null vectors, those of another length and those with null or non-finite components take no part. Repeated
    rows and null ids are vectors of their own. With fewer vectors than centroids every vector starts one. A
    distance beyond 64 bits is null.
    """
    spark = table.sparkSession
    rows = usable(table, components, vec_id, embedding)
    before = spark.conf.get(_BATCH)
    try:
        return _clusters(spark, rows, components, number, rounds, seed, scale)
    finally:
        spark.conf.set(_BATCH, before)


def _clusters(spark, rows, components, number, rounds, seed, scale):
    first = starts(rows, number, seed, scale)
    if not first:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), []
    now = Centroids(first)
    spark.conf.set(_BATCH, str(BLOCK))
    held = settle(blocks(rows, components, scale))
    spark.conf.set(_BATCH, str(BATCH_BLOCKS))
    folder = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    for turn in range(rounds):
        step = _assigned(held, now, components, scale)
        step.write.mode("overwrite").parquet(f"{folder}-{turn % 2}")
        held = spark.read.schema(step.schema).parquet(f"{folder}-{turn % 2}")
        means = _means(held, now.rows, components)
        if means == now.rows:      # further rounds would change nothing
            break
        now = Centroids(means, now.rows)
    return settle(_members(_assigned(held, now, components, scale), now, components, scale)), now.rows


def _members(table, centroids, dim, scale):
    kind = table.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x = _matrix(batch.column("x")[i].as_py(), batch.column("width")[i].as_py(), dim, scale)
                nearest = np.frombuffer(batch.column("nearest")[i].as_py(), "<i4")
                if x.dtype == object or not centroids.plain:
                    found = [d if d <= LONG else None for d in centroids.exact(x)[1]]
                else:
                    found = centroids.distance(x, nearest)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(nearest), pa.array(found, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    return table.select("ids", "width", "x", "nearest").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def assignments(table, **settings):
    """Every vector's vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Sums beyond 64 bits, and sums of such distances, are null.
    """
    rows, centroids = clusters(table, **settings)
    if not centroids:
        return rows.select("*", *[F.lit(None).cast(k).alias(n) for n, k in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    found = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()
    sums = {r.cluster: None if r.lost else int(r.s) for r in found}      # a row a centroid
    every = None if None in sums.values() else sum(sums.values())
    fits = lambda v: v if v is not None and v <= LONG else None
    names = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    of = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    return rows.select("*", of([fits(sums.get(c)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
                       F.lit(fits(every)).cast("long").alias("inertia"), of(names, "string").alias("centroid_sha256"))
