"""Documents to training sequences: quality rules, near copies, repeated passages, the mix of sources, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next
one's docs. All but the last return the columns of ``documents``.

- quality: documents that a rule rejects go.
- near_copies: of each component of similar documents the one with the smallest doc_id stays (one row of it).
- passages: every string of 200 bytes that starts at two places is cut out of the text; characters cut in the
  middle go, ``n_chars`` follows, and no row goes.
- mix: each source is taken towards its target; a document comes as often as it is taken.
- pack: the pieces of sequences of 2048 tokens.
"""

from pyspark.sql import functions as F

from campuswatt.llm import cube_mixing, jaccard_join, packing, quality_cascade, suffix_dedup
from campuswatt.llm.common import bound_batches, settle


def quality(spark, docs, sf_dir):
    """Rows that no quality rule rejects, as they are. A null or empty text has too few words and goes."""
    bound_batches(spark)
    return quality_cascade.keep(docs)


def near_copies(spark, docs, sf_dir):
    """One row of each class of similar texts: the smallest doc_id, a null id last; texts without words stay."""
    return jaccard_join.one_each(docs)


def passages(spark, docs, sf_dir):
    """All rows, without the strings that repeat; a null text stays null. ``n_chars``, where there is one, follows."""
    cut = suffix_dedup.removed(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix(spark, docs, sf_dir):
    """Every row as often as the mix takes it; a null source is a source, a text without words is taken by number only."""
    return cube_mixing.mixed(docs)


def pack(spark, docs, sf_dir):
    """Pieces of sequences; a null text is its end token alone. Other columns than doc_id and text are not read."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("mix", mix), ("pack", pack)]

#: SQL has no tokenizer and no balanced sampling; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
