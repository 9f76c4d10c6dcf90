"""Merges of a batch into a stored table.

Every merge returns the merged rows with ``_action`` (insert, update,
unchanged, keep) and the number of batch rows behind it, so that counters and
the new table come from one plan.
"""

import math
from functools import reduce

from pyspark.sql import Window as W, functions as F

from campuswatt.operators.joins import not_in
from campuswatt.operators.ordering import dedup_first
from campuswatt.session import cut_lineage

TOLERANCE = 0.001           # fixed value: smaller differences are no change
HOT_ROWS = 50_000           # keys with more rows in a batch are folded in ordered segments
SEGMENT_ROWS = 200_000      # rows of hot keys per segment, about
BROADCAST_KEYS = 200_000    # a counted key list up to this size is broadcast
BUCKETS = 1 << 16           # hash buckets in which the rows of a batch are counted


def _differs(old, new, measures, exact, tol):
    """SQL: any measure moved by more than ``tol`` or any exact column changed."""
    tests = [f"coalesce(abs({old}.`{m}` - {new}.`{m}`) > {tol}D, false)" for m in measures]
    tests += [f"coalesce({old}.`{m}` <> {new}.`{m}`, false)" for m in exact]
    return "(" + " OR ".join(tests) + ")"


def _struct(cols, of=""):
    return "named_struct(" + ", ".join(f"'{c}', {of}`{c}`" for c in cols) + ")"


def _fold_rows(known, measures, exact, tol):
    """Apply the ordered rows ``_list`` to the stored state: tiny drifts never move it."""
    cols = [*measures, *exact]
    moved = _differs("a.v", "x", measures, exact, tol)
    return F.expr(f"""aggregate(_list, named_struct('known', {known}, 'v', {_struct(cols)}, 'n', 0L), (a, x) -> CASE
        WHEN NOT a.known THEN named_struct('known', true, 'v', {_struct(cols, "x.")}, 'n', a.n)
        WHEN {moved} THEN named_struct('known', true, 'v', {_struct(cols, "x.")}, 'n', a.n + 1L)
        ELSE a END)""")


def _segment_function(state, measures, exact, tol):
    """Effect of an ordered run of rows ``_list`` on *any* state, as a short list of cases.

    A run moves a state at the first row that differs from it. Only a row that sets
    a new extreme can be that row, and only until the run has spread so far that
    every state has moved. Case: first row, state after the run, updates.
    """
    cols = [*measures, *exact]
    value = _struct(cols, "x.")
    fresh = f"named_struct('first', {value}, 'v', {value}, 'n', 1L)"
    lo = "named_struct(" + ", ".join([f"'{m}', least(a.lo.`{m}`, x.`{m}`)" for m in measures]
                                     + [f"'{m}', coalesce(a.lo.`{m}`, x.`{m}`)" for m in exact]) + ")"
    hi = "named_struct(" + ", ".join([f"'{m}', greatest(a.hi.`{m}`, x.`{m}`)" for m in measures]
                                     + [f"'{m}', coalesce(a.hi.`{m}`, x.`{m}`)" for m in exact]) + ")"
    extreme = " OR ".join([f"coalesce(x.`{m}` < a.lo.`{m}` OR x.`{m}` > a.hi.`{m}`, true)" for m in measures]
                          + [f"NOT (a.lo.`{m}` <=> x.`{m}`)" for m in exact])
    # twice the tolerance would do; three times keeps rounding out of the argument
    spread = " OR ".join([f"coalesce(greatest(a.hi.`{m}`, x.`{m}`) - least(a.lo.`{m}`, x.`{m}`) > {3 * tol}D, false)"
                          for m in measures] + [f"coalesce(a.lo.`{m}` <> x.`{m}`, false)" for m in exact])
    advanced = f"""transform(a.cases, c -> CASE WHEN {_differs("c.v", "x", measures, exact, tol)}
        THEN named_struct('first', c.first, 'v', {value}, 'n', c.n + 1L) ELSE c END)"""
    start = (f"named_struct('cases', cast(array() AS array<struct<first:{state},v:{state},n:bigint>>), "
             f"'lo', cast(NULL AS {state}), 'hi', cast(NULL AS {state}), 'open', true)")
    return F.expr(f"""aggregate(_list, {start}, (a, x) -> named_struct(
        'cases', CASE WHEN a.open AND ({extreme}) THEN concat({advanced}, array({fresh})) ELSE {advanced} END,
        'lo', {lo}, 'hi', {hi}, 'open', a.open AND NOT ({spread})), a -> a.cases)""")


def _fold_segments(known, measures, exact, tol):
    """Apply the functions of the ordered segments ``_segs`` to the stored state."""
    hit = f"get(filter(g.cases, c -> NOT a.known OR {_differs('a.v', 'c.first', measures, exact, tol)}), 0)"
    return F.expr(f"""aggregate(_segs, named_struct('known', {known}, 'v', {_struct([*measures, *exact])}, 'n', 0L), (a, g) -> CASE
        WHEN {hit} IS NULL THEN a
        ELSE named_struct('known', true, 'v', {hit}.v, 'n', a.n + {hit}.n - CASE WHEN a.known THEN 0L ELSE 1L END) END)""")


def _order_struct(order):
    return F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])


def _small(keys, n):
    """Broadcast a key list whose size was counted; beyond the bound the planner shuffles."""
    return F.broadcast(keys) if n <= BROADCAST_KEYS else keys


def _hot_keys(batch, key, hot_rows):
    """(most, hot): a bound on the rows of any key, and the keys with more than ``hot_rows`` rows (None: there are none).

    Rows are counted by a hash of the key, so a task hands on no more than ``BUCKETS`` counts. A key cannot have
    more rows than its bucket: only the rows of too large buckets, and those of a small batch, are counted by key.
    """
    placed = batch.dropna(subset=list(key)).select(*key, F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).alias("_bucket"))
    counts = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    n, most = counts.agg(F.sum("_n"), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most > 1 and n <= BUCKETS:
        most = placed.groupBy(*key).count().agg(F.max("count")).first()[0]
    if most <= hot_rows:
        return most, None
    large = F.broadcast(counts.filter(F.col("_n") > hot_rows).select("_bucket"))
    sizes = placed.join(large, "_bucket", "left_semi").groupBy(*key).agg(F.count("*").alias("_rows"))
    hot = cut_lineage(sizes.filter(F.col("_rows") > hot_rows))
    return most, None if hot.isEmpty() else hot


def _folded(stored, batch, key, measures, exact, order, tol, hot_rows, segments):
    """Join the stored rows with the batch, folded per key.

    Adds ``_known`` (stored before), ``_rows`` (batch rows of the key) and ``_new``
    (struct of the state ``v`` after the batch and the number ``n`` of moves).

    The batch is shuffled once: its rows and the stored ones meet per key. Keys with more than ``hot_rows`` rows
    are cut into ordered segments, so that no group is unbounded; a batch without repeated keys needs no lists.
    """
    on, cols = list(key), [*measures, *exact]
    batch = batch.select(*key, *[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in cols],
                         *[c for c in order if c not in key and c not in cols])
    stored = stored.select(*key, *cols)
    most, hot = _hot_keys(batch, key, hot_rows)
    if most <= 1:
        return _folded_single(stored, batch, on, cols, measures, exact, tol)
    if hot is None:
        return _folded_lists(stored, batch, on, cols, measures, exact, order, tol)
    n_hot, hot_total = hot.agg(F.count("*"), F.sum("_rows")).first()
    keys = _small(hot.select(*key), n_hot)
    cold = _folded_lists(stored.join(keys, on, "left_anti"), batch.join(keys, on, "left_anti"), on, cols, measures, exact, order, tol)
    state = "struct<" + ",".join(f"`{c}`:{stored.schema[c].dataType.simpleString()}" for c in cols) + ">"
    parallel = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = segments or max(parallel, math.ceil(hot_total / SEGMENT_ROWS))
    segs = _segments(batch.join(keys, on, "left_semi"), key, cols, order, segments, _segment_function(state, measures, exact, tol))
    held = stored.join(keys, on, "left_semi").withColumn("_known", F.lit(True))
    rest = hot.join(held, on, "left").join(segs, on, "left").withColumn("_known", F.col("_known").isNotNull())
    rest = rest.withColumn("_new", _fold_segments("_known", measures, exact, tol))
    return cold.unionByName(rest.select(*cold.columns))


def _folded_single(stored, batch, on, cols, measures, exact, tol):
    """:func:`_folded` of keys with a single row: a plain aggregate has them ready. Of repeated null keys no row counts."""
    sizes = batch.groupBy(*on).agg(F.count("*").alias("_rows"), *[F.min(c).alias(f"_one_{c}") for c in cols])
    out = stored.withColumn("_known", F.lit(True)).join(sizes, on, "full_outer").withColumn("_known", F.col("_known").isNotNull())
    one = "named_struct(" + ", ".join(f"'{c}', `_one_{c}`" for c in cols) + ")"
    moved = _differs(_struct(cols), one, measures, exact, tol)
    single = (f"CASE WHEN _rows = 1 AND (NOT _known OR {moved}) THEN named_struct('known', true, 'v', {one}, "
              f"'n', CASE WHEN _known THEN 1L ELSE 0L END) "
              f"WHEN _rows = 1 THEN named_struct('known', true, 'v', {_struct(cols)}, 'n', 0L) END")
    return out.select(*on, *cols, "_known", "_rows", F.expr(single).alias("_new"))


def _folded_lists(stored, batch, on, cols, measures, exact, order, tol):
    """:func:`_folded` of keys whose rows fit a list: stored rows and batch rows meet in one aggregate.

    A null key equals no other. Stored rows with one stay as they are, of repeated batch rows with one no row counts.
    """
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    row = F.struct(_order_struct(order).alias("o"), *cols)
    rows = batch.select(*on, F.lit(False).alias("_apart"), F.lit(1).alias("_in"), F.when(full, row).alias("_row"),
                        F.when(~full, row).alias("_lone"), F.lit(None).cast(stored.select(F.struct(*cols)).schema[0].dataType).alias("_state"))
    kinds = rows.schema
    held = stored.select(*on, (~full).alias("_apart"), F.lit(None).cast("int").alias("_in"),
                         *[F.lit(None).cast(kinds[c].dataType).alias(c) for c in ("_row", "_lone")], F.struct(*cols).alias("_state"))
    met = rows.unionByName(held).groupBy(*on, "_apart").agg(
        F.count("_in").alias("_rows"), F.sort_array(F.collect_list("_row")).alias("_list"), F.min("_lone").alias("_lone"),
        F.collect_list("_state").alias("_held"))
    out = met.select(*on, F.nullif("_rows", F.lit(0)).alias("_rows"),
                     F.when(full, F.col("_list")).when(F.col("_rows") == 1, F.array("_lone")).alias("_list"),
                     F.explode_outer("_held").alias("_state"))
    out = out.select(*on, "_rows", "_list", F.col("_state").isNotNull().alias("_known"), "_state.*")
    return out.select(*on, *cols, "_known", "_rows", _fold_rows("_known", measures, exact, tol).alias("_new"))


def _segments(rows, key, cols, order, segments, function):
    """Ordered segments of hot keys: range partitions on (key, order) cut them into even runs."""
    row = F.struct(_order_struct(order).alias("o"), *cols)
    runs = (rows.repartitionByRange(segments, *key, *order).withColumn("_seg", F.spark_partition_id())
            .groupBy(*key, "_seg").agg(F.sort_array(F.collect_list(row)).alias("_list"))
            .withColumn("cases", function))
    return runs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_seg", "cases"))).alias("_segs"))


def upsert_tol(target, batch, key, measures, order, exact=(), tol=TOLERANCE, hot_rows=HOT_ROWS, segments=None):
    """Tolerance upsert: rows of a key apply in order to the running state.

    A row inserts an absent key; it replaces all measures if any moved by more
    than ``tol`` or an ``exact`` column changed; otherwise it changes nothing, so
    drifts below the tolerance never move the stored value. Values are not null
    on either side: the feeds' standard forms see to that.
    """
    cols = [*measures, *exact]
    out = _folded(target, batch, key, measures, exact, order, tol, hot_rows, segments)
    absent = F.col("_rows").isNull()
    moves = F.coalesce("_new.n", F.lit(0))
    return out.select(
        *key, *[F.when(absent, F.col(c)).otherwise(F.col(f"_new.v.{c}")).alias(c) for c in cols],
        F.when(absent, "keep").when(~F.col("_known"), "insert").when(moves > 0, "update")
        .otherwise("unchanged").alias("_action"),
        F.coalesce("_rows", F.lit(0)).alias("_rows"),
        F.when(F.col("_known"), 0).otherwise(1).cast("bigint").alias("_inserted"), moves.alias("_updated"))


def _fold_measures(measures, tol):
    """SQL: run the ordered rows ``_list`` over the stored measures, each moving on its own.

    A measure holds its value and the number of its changes. The first value of a gap is a change, unless it
    comes with the row that inserts the key.
    """
    start = "named_struct(" + ", ".join(f"'{m}', named_struct('v', `{m}`, 'n', 0L)" for m in measures) + ")"
    fresh = "NOT _stored AND x.o = get(_list, 0).o"
    moves = []
    for m in measures:
        moves.append(f"""'{m}', CASE WHEN x.`{m}` IS NULL THEN a.`{m}`
            WHEN a.`{m}`.v IS NULL THEN named_struct('v', x.`{m}`, 'n', a.`{m}`.n + CASE WHEN {fresh} THEN 0L ELSE 1L END)
            WHEN abs(a.`{m}`.v - x.`{m}`) > {tol}D THEN named_struct('v', x.`{m}`, 'n', a.`{m}`.n + 1L)
            ELSE a.`{m}` END""")
    return f"aggregate(_list, {start}, (a, x) -> named_struct({', '.join(moves)}))"


def merge_nonnull(target, batch, key, measures, order, tol=TOLERANCE, hot_rows=HOT_ROWS, segments=None):
    """Null-aware merge: each non-null measure fills a gap or replaces a value that moved.

    NULL never overwrites. The measures move independently, in one fold over the rows of a key; ``_updated``
    counts changed measures. Keys with more than ``hot_rows`` rows, if there are any, are folded in segments,
    measure by measure.
    """
    sizes = batch.groupBy(*key).agg(F.count("*").alias("_n"))
    hot = sizes.filter(F.col("_n") > hot_rows).select(*key)
    n_hot = hot.count()
    if not n_hot:
        return _merged_at_once(target, batch, key, measures, order, tol)
    hot = _small(cut_lineage(hot), n_hot)
    on = list(key)
    cold = _merged_at_once(target.join(hot, on, "left_anti"), batch.join(hot, on, "left_anti"), key, measures, order, tol)
    rest = _merged_by_measure(target.join(hot, on, "left_semi"), batch.join(hot, on, "left_semi"), key, measures, order, tol, hot_rows, segments)
    return cold.unionByName(rest)


def _merged_at_once(target, batch, key, measures, order, tol):
    """One shuffle of the batch: the few rows of a key are put in order and folded."""
    kinds = {m: target.schema[m].dataType for m in measures}
    row = F.struct(_order_struct(order).alias("o"), *[F.col(m).cast(kinds[m]).alias(m) for m in measures])
    rows = batch.groupBy(*key).agg(F.sort_array(F.collect_list(row)).alias("_list"))
    out = (target.select(*key, *measures).withColumn("_stored", F.lit(True)).join(rows, list(key), "full_outer")
           .withColumn("_stored", F.col("_stored").isNotNull()))
    out = out.withColumn("_state", F.when(F.col("_list").isNotNull(), F.expr(_fold_measures(measures, tol))))
    changes = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"_state.{m}.n"), F.lit(0)) for m in measures])
    return out.select(
        *key, *[F.when(F.col("_state").isNull(), F.col(m)).otherwise(F.col(f"_state.{m}.v")).alias(m) for m in measures],
        F.when(F.col("_list").isNull(), "keep").when(~F.col("_stored"), "insert").when(changes > 0, "update")
        .otherwise("unchanged").alias("_action"),
        F.when(F.col("_list").isNull(), 0).otherwise(F.size("_list")).cast("bigint").alias("_rows"),
        F.when(F.col("_stored"), 0).otherwise(1).cast("bigint").alias("_inserted"), changes.alias("_updated"))


def _merged_by_measure(target, batch, key, measures, order, tol, hot_rows, segments):
    """The same for hot keys: each measure is folded over its non-null rows, in ordered segments."""
    batch = batch.withColumn("_at", _order_struct(order))
    rows = batch.groupBy(*key).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    out = (target.select(*key).withColumn("_stored", F.lit(True)).join(rows, list(key), "full_outer")
           .withColumn("_stored", F.col("_stored").isNotNull()))
    for m in measures:
        given = batch.filter(F.col(m).isNotNull())
        one = _folded(target.filter(F.col(m).isNotNull()), given, key, [m], (), order, tol, hot_rows, segments)
        since = given.groupBy(*key).agg(F.min("_at").alias("_since"))
        one = one.select(*key, F.coalesce(F.col(f"_new.v.{m}"), F.col(m)).alias(m), F.col("_known").alias("_had"),
                         F.coalesce("_new.n", F.lit(0)).alias("_moves"))
        out = out.join(one, list(key), "left").join(since, list(key), "left")
        # the first value of a gap is an update, unless it comes with the row that inserts the key
        filled = ~F.col("_had") & (F.col("_stored") | (F.col("_since") > F.col("_first")))
        out = (out.withColumn(f"_n_{m}", F.coalesce("_moves", F.lit(0)) + F.when(filled, 1).otherwise(0))
               .drop("_had", "_moves", "_since"))
    changes = reduce(lambda a, b: a + b, [F.col(f"_n_{m}") for m in measures])
    return out.select(
        *key, *measures,
        F.when(F.col("_n").isNull(), "keep").when(~F.col("_stored"), "insert").when(changes > 0, "update")
        .otherwise("unchanged").alias("_action"),
        F.coalesce("_n", F.lit(0)).alias("_rows"),
        F.when(F.col("_stored"), 0).otherwise(1).cast("bigint").alias("_inserted"), changes.alias("_updated"))


def insert_only(target, batch, key, valid, order):
    """First valid row of each key the target lacks. Stored rows never change."""
    fresh = not_in(batch.filter(F.coalesce(valid, F.lit(False))), target, key)
    return dedup_first(fresh, key, order)


def insert_only_stats(target, batch, key, valid, order):
    """Counters of :func:`insert_only`: the duplicate test comes before the validity test."""
    at = _order_struct(order)
    marked = batch.withColumns({"_ok": F.coalesce(valid, F.lit(False)), "_at": at})
    first = marked.filter("_ok").groupBy(*key).agg(F.min("_at").alias("_first"))
    stored = target.select(*key).distinct().withColumn("_stored", F.lit(True))
    rows = marked.join(stored, list(key), "left").join(first, list(key), "left")
    action = (F.when(F.col("_stored"), "duplicate").when(F.col("_at") > F.col("_first"), "duplicate")
              .when(F.col("_ok"), "inserted").otherwise("invalid"))
    return rows.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


def replace_dates(target, batch, date):
    """Rows of the batch replace all target rows of its dates."""
    kept = not_in(target, batch.select(date).distinct(), [date])
    return kept.unionByName(batch.select(*target.columns))


def snapshot_diff(target, batch, date="date", ext="external_id", known_dates=None, row_id=None):
    """Soft-delete active rows on the snapshot's dates that the snapshot no longer has.

    ``known_dates`` restricts the dates (only dates known before the file count).
    If ``row_id`` is given, of several active rows with one external id only the
    last one is deactivated.
    """
    dates = batch.select(date).distinct()
    if known_dates is not None:
        dates = dates.join(known_dates.select(date), date, "left_semi")
    gone = (target.filter(F.col("is_active") & F.col(ext).isNotNull())
            .join(dates, date, "left_semi")
            .join(batch.select(ext).distinct(), ext, "left_anti"))
    if row_id is None:
        marks, on = gone.select(ext, date).distinct(), [ext, date]
    else:
        marks, on = gone.groupBy(ext).agg(F.max(row_id).alias(row_id)), [ext, row_id]
    marked = target.join(marks.withColumn("_gone", F.lit(True)), on, "left")
    return (marked.withColumn("_deactivated", F.col("is_active") & F.coalesce("_gone", F.lit(False)))
            .withColumn("is_active", F.col("is_active") & ~F.col("_deactivated"))
            .select(*target.columns, "_deactivated"))


def _presence(held):
    """SQL: run the ordered snapshots ``_list`` of a key over its active ids ``held``; gives every start and end.

    An id is active until the first snapshot without it. A key without an active id takes the first id of the
    next snapshot that has one; a snapshot that ends an id starts none. Ids that are NULL never end.
    """
    event = "struct<at:int,ext:string,starts:boolean>"
    ends = lambda ids, at: f"transform(filter({ids}, e -> e IS NOT NULL), e -> named_struct('at', {at}, 'ext', e, 'starts', false))"
    first = "named_struct('at', x.s, 'ext', x.first, 'starts', true)"
    start = f"named_struct('active', {held}, 'last', 0, 'events', cast(array() AS array<{event}>))"
    # a snapshot between that did not have the key ended what was active
    gap = f"""named_struct('active', CASE WHEN x.s > a.last + 1 THEN filter(a.active, e -> e IS NULL) ELSE a.active END,
        'events', CASE WHEN x.s > a.last + 1 THEN concat(a.events, {ends('a.active', 'a.last + 1')}) ELSE a.events END)"""
    lost = "filter(g.active, e -> NOT array_contains(x.exts, e))"
    step = f"""CASE WHEN size(g.active) = 0
        THEN named_struct('active', array(x.first), 'last', x.s, 'events', concat(g.events, array({first})))
        ELSE named_struct('active', filter(g.active, e -> e IS NULL OR array_contains(x.exts, e)), 'last', x.s,
                          'events', concat(g.events, {ends(lost, 'x.s')})) END"""
    return f"""aggregate(_list, {start}, (a, x) -> element_at(transform(array({gap}), g -> {step}), 1),
        a -> CASE WHEN a.last < _snapshots THEN concat(a.events, {ends('a.active', 'a.last + 1')}) ELSE a.events END)"""


def snapshot_history(target, rows, date, key, order, ext="external_id", snapshot="file"):
    """Apply several snapshots of the same dates, in order of ``snapshot``, in one plan.

    Returns (stored, fresh). ``stored`` are the target's rows with ``is_active`` after the last snapshot and
    ``_gone``, the snapshot that ended the row. ``fresh`` are the rows to insert, with their snapshot and the
    same two columns. A snapshot stands for all bookings of the dates it has. An id belongs to one key; of
    several rows with a key, and of its ids, the first in ``order`` counts. Per key only its ids per snapshot
    are put together.
    """
    covered = rows.select(date, snapshot).distinct()
    numbered = covered.withColumns({
        "_s": F.row_number().over(W.partitionBy(date).orderBy(snapshot)), "_snapshots": F.count("*").over(W.partitionBy(date))})
    numbered = cut_lineage(numbered)
    placed = rows.join(numbered.drop("_snapshots"), [date, snapshot])
    seen = placed.groupBy(*key, "_s").agg(F.min_by(ext, _order_struct(order)).alias("first"), F.collect_set(ext).alias("exts"))
    lists = seen.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("_s").alias("s"), "first", "exts"))).alias("_list"))
    held = target.filter("is_active").groupBy(*key).agg(F.collect_set(F.struct(F.col(ext).alias("e"))).alias("_held"))
    none = "cast(array() AS array<struct<s:int,first:string,exts:array<string>>>)"
    keys = (lists.join(held, list(key), "full_outer").join(numbered.select(date, "_snapshots").distinct(), date)
            .withColumn("_list", F.expr(f"coalesce(_list, {none})"))
            .withColumn("_held", F.expr("coalesce(transform(_held, h -> h.e), cast(array() AS array<string>))"))
            .select(*key, F.expr(_presence("_held")).alias("_events")))
    events = cut_lineage(keys.select(*key, "_events", F.explode("_events").alias("_event")).select(*key, "_events", "_event.*"))

    def named(df, at, into):
        """The snapshot with a number of its date."""
        names = numbered.select(date, F.col("_s").alias(at), F.col(snapshot).alias(into))
        return df.join(names, [date, at], "left").drop(at)

    ended = events.filter("NOT starts").groupBy(*key, F.col("ext").alias(ext)).agg(F.min("at").alias("_at"))
    # only the first end of an id is that of its stored row
    stored = target.join(ended.withColumn("is_active", F.lit(True)), [*key, ext, "is_active"], "left")
    stored = named(stored, "_at", "_gone").withColumn("is_active", F.col("is_active") & F.col("_gone").isNull())
    end = "array_min(transform(filter(_events, g -> NOT g.starts AND g.ext = ext AND g.at > at), g -> g.at))"
    started = events.filter("starts").select(*key, F.col("at").alias("_s"), F.expr(end).alias("_at"))
    firsts = dedup_first(placed, [*key, "_s"], order)
    fresh = named(firsts.join(started, [*key, "_s"]).drop("_s"), "_at", "_gone").withColumn("is_active", F.col("_gone").isNull())
    return stored.select(*target.columns, "_gone"), fresh


def booking_insert(target, batch, key, order, ext="external_id", scope=None):
    """Rows of the batch that are new: neither their external id nor their key is active yet.

    ``scope`` are the dates whose stored external ids count.
    """
    active = target.filter("is_active")
    ids = active.filter(F.col(ext).isNotNull())
    if scope is not None:
        name = scope.columns[0]
        ids = ids.join(scope, name, "left_semi")
    fresh = not_in(not_in(batch, ids, [ext]), active, key)
    return dedup_first(fresh, key, order)


def load_stats(merged):
    """Counters of a merge in long form."""
    totals = merged.agg(F.sum("_rows").alias("p"), F.sum("_inserted").alias("i"), F.sum("_updated").alias("u"))
    counters = {"processed": F.col("p"), "inserted": F.col("i"), "updated": F.col("u"),
                "unchanged": F.col("p") - F.col("i") - F.col("u")}
    return totals.select(F.explode(F.create_map(
        *[x for name, n in counters.items() for x in (F.lit(name), n)])).alias("counter", "n"))
