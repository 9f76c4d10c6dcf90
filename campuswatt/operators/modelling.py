"""Splits, scaling and metrics around the forecast models."""

from pyspark.sql import functions as F

from campuswatt.operators.ordering import global_position

TEST_SHARE = 0.2       # fixed value
SEED = 42              # fixed value
MAPE_FLOOR = 0.01      # fixed value: smallest denominator of the percentage error


def chrono_split(df, order, share=TEST_SHARE, into="is_test"):
    """Mark the last ``share`` of the rows as test rows, at least one.

    Returns rows with ``is_train`` and ``is_test``: a single row is both.
    """
    placed = global_position(df, order, into="_pos")
    n = placed.agg(F.count("*")).scalar()
    placed = placed.withColumn("_n", n)
    test_rows = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(share)))
    first_test = F.when(F.col("_n") == 1, 0).otherwise(F.col("_n") - test_rows)
    is_test = F.col("_pos") >= first_test
    return placed.withColumns({
        into: is_test.cast("int"),
        "is_train": (~is_test | (F.col("_n") == 1)).cast("int")}).drop("_pos", "_n")


def draw(key, seed):
    """A number of 0 to 9999 from the MD5 of the row key: the same on any layout and in any engine."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000


def hash_split(df, key, train_pct=80, seed=SEED):
    """Stable random split by a hash of the row key."""
    return df.withColumn("is_train", (draw(key, seed) < train_pct * 100).cast("int"))


def sample_rows(df, key, fraction, seed=SEED):
    """A stable random share of the rows."""
    return df.filter(draw(key, seed) < int(fraction * 10_000))


def scaling(train, cols):
    """One row with mean and population deviation of each column (deviation 0 counts as 1)."""
    aggs = []
    for c in cols:
        dev = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"), F.when(dev == 0, F.lit(1.0)).otherwise(dev).alias(f"std_{c}")]
    return train.agg(*aggs)


def zscore(df, cols, train=None):
    """Standard scores by the training rows' mean and population deviation."""
    stats = scaling(df if train is None else train, cols)
    return df.withColumns({
        c: (F.col(c) - stats.select(f"mean_{c}").scalar()) / stats.select(f"std_{c}").scalar() for c in cols})


def category_codes(df, cols, train=None):
    """Alphabetical codes from the training rows; NULL and unseen values are -1, a constant column is 0."""
    train = df if train is None else train
    for c in cols:
        values = train.select(c).dropna().distinct()
        codes = global_position(values, [c], into="_code")
        distinct = values.agg(F.count("*")).scalar()
        df = df.join(codes, c, "left").withColumn(
            c, F.when(distinct <= 1, F.lit(0)).otherwise(F.coalesce("_code", F.lit(-1)))).drop("_code")
    return df


def residuals(df, actual="actual", predicted="predicted"):
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def metric_columns(actual="actual", predicted="predicted"):
    """RMSE, MAE, R2, MAPE and RSS as aggregates of one pass."""
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    rss, n = F.sum(error * error), F.count("*")
    spread = F.var_pop(y) * n
    return [F.sqrt(rss / n).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
            F.try_divide(spread - rss, spread).alias("r2"),
            (F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))) * 100).alias("mape"),
            rss.alias("rss"), n.alias("n")]


def metrics(df, actual="actual", predicted="predicted", by=()):
    return df.groupBy(*by).agg(*metric_columns(actual, predicted))


def daily_metrics(df, ts="ts", actual="actual", predicted="predicted"):
    """Metrics of the daily sums."""
    daily = df.groupBy(F.to_date(ts).alias("date")).agg(F.sum(actual).alias(actual), F.sum(predicted).alias(predicted))
    return metrics(daily, actual, predicted)


def folds(df, k, order, into="fold"):
    """Contiguous folds in row order; the first ``n mod k`` folds have one row more."""
    placed = global_position(df, order, into="_pos")
    n = placed.agg(F.count("*")).scalar()
    placed = placed.withColumn("_n", n)
    small = F.floor(F.col("_n") / k)
    large_rows = (F.col("_n") % k) * (small + 1)
    fold = F.when(F.col("_pos") < large_rows, F.floor(F.col("_pos") / (small + 1))) \
        .otherwise(F.col("_n") % k + F.floor((F.col("_pos") - large_rows) / F.greatest(small, F.lit(1))))
    return placed.withColumn(into, fold.cast("int")).drop("_pos", "_n")


def fold_metrics(df, k, order, actual="actual", predicted="predicted"):
    """Metrics per contiguous fold."""
    return metrics(folds(df, k, order), actual, predicted, by=["fold"])
