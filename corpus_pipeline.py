"""A training corpus in five stages, each one of the operators in tillroll.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, ngram_join, packing, pii, quality
from tillroll.llm.common import table
from tillroll.llm.queries import quality_model, tokenizer_file
from tillroll.session import shared_dir

#: SQL cannot express the classifier, the forest or the packing; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def whole(docs: DataFrame) -> DataFrame:
    """The rows as one column, beside the texts: operators then cannot clash with the documents' columns."""
    return docs.select(F.struct(*docs.columns).alias("doc"), "text")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model(spark, docs.select("doc_id", "text"), sf_dir)
    return quality.with_quality(whole(docs), model).filter("keep").select("doc.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.without_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items; these stay as they are."""
    found = decontaminate.find(whole(docs), table(spark, sf_dir, "benchmark"), keep=["doc"])
    return found.filter(~decontaminate.contaminated(F.col("n_words"), F.col("n_hit"))).select("doc.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked, and their new lengths. The candidates are searched once
    and kept with their documents until the classifier is trained."""
    found = pii.find(whole(docs), keep=["doc"])
    text = pii.masked(F.col("doc.text"), F.col("spans"))
    length = F.when(F.size("spans") > 0, F.length(text).cast("long")).otherwise(F.col("doc.n_chars"))
    return found.select(*({"text": text, "n_chars": length}.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids, their sequence and place in it.

    The pieces are written once; only their lengths are packed, and the ids
    meet their places in one join.
    """
    folder = shared_dir(spark, f"corpus-pieces-{uuid.uuid4().hex}")
    pieces = packing.piece_tokens(docs, tokenizer_file("word_bpe_49k.json"))
    pieces.withColumn("piece_id", F.monotonically_increasing_id()).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    placed = packing.pack(pieces.select("piece_id", "length")).drop("length")
    return pieces.join(placed, "piece_id").select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "ids", "sequence_id", "offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the tokens of each sequence, little-endian unsigned 32-bit; 2,048 at most."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined: Column = F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("best-fit packing", pack_sequences),
]


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Corpus:
    """Where a run left its results: the masked documents, and the pieces of the packed sequences with their ids."""

    documents: str
    sequences: str


def build(spark: SparkSession, sf_dir: str, folder: str | None = None) -> Corpus:
    """The stages one after another over the documents of ``sf_dir``, under ``folder``
    (by default a new one in the shared folder). A stage's input goes when its output
    is written, so one copy of the corpus stays at a time; what the last stage packed
    stays beside its result."""
    docs = table(spark, sf_dir, "documents")
    folder = folder or shared_dir(spark, f"corpus-{uuid.uuid4().hex}")
    outs = [os.path.join(folder, str(i)) for i in range(len(STAGES))]
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(outs[i])
        docs = spark.read.parquet(outs[i])
        if 0 < i < len(STAGES) - 1:
            _remove(spark, outs[i - 1])
    return Corpus(documents=outs[-2], sequences=outs[-1])


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage of :func:`build`."""
    return spark.read.parquet(build(spark, sf_dir).sequences)
