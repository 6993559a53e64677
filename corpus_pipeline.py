"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; each result
is written as Parquet and read again as the next stage's documents. All but the
last return the columns of the documents, for all rows they keep. Extra columns
are passed on; a null text counts as empty. ``ORACLE_SQL`` is None, as SQL
cannot express a fitted classifier; the tests hold the stages against plain
versions instead.
"""

import public_tokenizers
from pyspark.sql import functions as F

from barograph.llm import bottomk, mixing, pii, quality, unigram
from barograph.llm.common import stored, table

VOCABULARY = "piece_bpe_32k.model"
MIX_BUDGET = 0.8
# Nearer to the shares there are than the operator's own default: so much is drawn here that
# stronger targets could not be met.
MIX_TEMPERATURE = 0.75
MOST_BROADCAST_IDS = 100_000
ORACLE_SQL = None


def as_before(df, docs):
    """The columns of ``docs``, in their order; names may hold any character."""
    return df.select(*["`" + name.replace("`", "``") + "`" for name in docs.columns])


def quality_stage(spark, docs, sf_dir):
    """Documents the base rules and the classifier accept.

    The classifier learns from the labelled documents of the input tables. A
    document that repeats is judged once for all of its rows, by its text.
    """
    model = quality.learn_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return quality.kept_rows(docs, model)


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group: the one with the smallest id.

    Rows without id join no group. Of rows that repeat one id and text, and of rows
    without id that repeat a text, one stays; which of them is not defined where
    their other columns differ. Rows of one id with different texts stay, unless their
    group has a smaller id. Ties cannot occur among ids. An empty table gives an empty
    result, and documents without words are kept.
    """
    found = bottomk.near_duplicates(docs)
    dropped = found.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    kept = as_before(docs.join(dropped, "doc_id", "left_anti"), docs)
    return once_per_text(kept, docs)


def once_per_text(kept, docs):
    """Rows whose id occurs several times, reduced to one per text; all others as they are.

    Ids that repeat are looked up first, so that texts are only compared where there
    is something to compare.
    """
    repeated = stored(
        docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return kept
    small = repeated.limit(MOST_BROADCAST_IDS + 1).count() <= MOST_BROADCAST_IDS
    ids = F.broadcast(repeated) if small else repeated
    same = kept["doc_id"].eqNullSafe(ids["doc_id"])
    several = kept.join(ids, same, "left_semi")
    return kept.join(ids, same, "left_anti").unionByName(several.dropDuplicates(["doc_id", "text"]))


def pii_stage(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.mask_texts(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
        masked = masked.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return as_before(masked, docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents drawn so that sources, languages and forms meet tempered shares.

    Rows come back as they are, extra columns of any name included. Equal rows are
    drawn alike, null keys form a group of their own, and an empty table stays empty.
    """
    return mixing.drawn(docs, stored, budget=MIX_BUDGET, temperature=MIX_TEMPERATURE)


def encoding_stage(spark, docs, sf_dir):
    """``doc_id, lang, source`` with the piece ids of every whole text, checked by decoding."""
    return unigram.encode_texts(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", pii_stage),
    ("mixing to target weights", mixing_stage),
    ("piece encoding", encoding_stage),
]


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
