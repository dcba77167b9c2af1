"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all documents
its predecessor kept; what it returns is written as Parquet and read again as
the next one's documents. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.llm.jaccard import Rule, linked_documents
from dialtrail.llm.langid import HELD_OUT_MOD, UNDETERMINED, predict, remainder, train
from dialtrail.llm.mixing import mix
from dialtrail.llm.packing import pack, random_group, stored_pieces
from dialtrail.llm.surrogates import replace_entities
from dialtrail.llm.texts import fresh_name, pack_texts, unpack_texts
from dialtrail.operators.staging import staged


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language was found for; it fills in a missing label.
    Texts without a letter, null ones included, go. With no label to learn from,
    every text with a letter stays, its label as it is."""
    model = train(docs, remainder("doc_id", HELD_OUT_MOD) != 0)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    predicted, score = (fresh_name(docs.columns, c) for c in ("lang_pred", "score"))
    found = predict(docs, model, docs.columns, predicted, score)
    known = F.col(predicted) != UNDETERMINED
    filled = F.coalesce("lang", predicted).alias("lang")
    return found.filter(known).select(*[filled if c == "lang" else c for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by id of each group linked by word 5-grams with a
    Jaccard index of 0.8 or more; equal ids go by their place in the table, and
    missing ones come last."""
    row = fresh_name(docs.columns, "_row")
    # Written once: numbers taken anew by each job would follow how it cuts the table.
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    linked = linked_documents(
        numbered.select(F.col(row).alias("doc_id"), "text"), Rule(words=5, share=80)
    ).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    ids = numbered.select(F.col(row).alias("_row"), F.col("doc_id").alias("_id"))
    owned = linked.join(ids, "_row")
    least = owned.groupBy("_group").agg(F.min("_id").alias("_least"))
    # Of the rows with a group's least id the first; a group without ids is all of them.
    rows = (
        owned.join(least, "_group")
        .filter(F.col("_id").eqNullSafe(F.col("_least")))
        .groupBy("_group")
        .agg(F.min("_row").alias(row))
        .select(row)
    )
    kept = pack_texts(numbered).hint("merge").join(rows, row, "left_semi").drop(row)
    return unpack_texts(kept)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by surrogates; n_chars follows, and
    is null for a null text. Empty texts and repeated rows stay as they are; no
    documents give none."""
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replace_entities(docs).withColumn("n_chars", n_chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, in the order of the mixture: each file written of
    these rows is one stretch of it, after those of the files before. A null
    source is one of its own; texts are not looked at; repeated rows are documents
    of their own; no documents give none."""
    order = ["mix_slot", "mix_place"]
    mixed = mix(docs, repeat=False)
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def pack_stretches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences. Groups are drawn at random within
    each file, so sequences in the order of their ids follow the mixture. Files
    are told by the number in Spark's own names; documents of files named
    otherwise are one stretch. A null or empty text is one piece, repeated rows
    each give theirs, and no documents give none."""
    file_number = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    stretch = F.coalesce(file_number.try_cast("bigint"), F.lit(0).cast("bigint"))
    pieces = stored_pieces(docs, stretch=stretch)
    return pack(pieces, random_group(pieces, within="stretch")).drop("stretch")


STAGES = [
    ("language_id", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_stretches),
]

# SQL cannot express the first, third, fourth and fifth stage; the tests check
# each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
