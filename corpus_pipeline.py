"""The corpus pipeline: documents -> good ones -> distinct ones -> uncontaminated ones -> mixed -> token files.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs. All but the last keep
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import decontaminate, minhash_dedup, mixing, quality, shared, token_files
from lumenfold.llm.queries import END_ID, MIX_BLOCK, WEIGHTS, table, tokenizer_path



def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of those not held out.

    Null, empty and blank texts are scored like any other, rows of one id each by its own text; all
    columns are kept, and an empty table gives an empty one."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


#: Words of a shingle, bits that linked fingerprints differ in at most, and the Jaccard similarity of sets
#: of shingles from which documents are near-duplicates.
SHINGLE, RADIUS, SIMILAR = 5, 3, 0.8


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id. Documents are linked if their
    SimHash fingerprints are near or if their shingle sets are similar enough.

    Null, empty and blank texts are one group; rows that share the least id of a group all stay, and so
    repeated rows do; rows without an id go if a row of their group has one."""
    return minhash_dedup.keep_one(spark, docs, SHINGLE, RADIUS, SIMILAR)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Null and empty texts contain none, and stay; rows are
    judged one by one, so repeated rows and ids share their fate only if they share their text."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the schedule: the rows of the files, in the order of the files.

    Null sources and ids come first; rows of one id are ordered by text; columns of all names are kept."""
    return mixing.interleave(docs, WEIGHTS, MIX_BLOCK)


#: Bytes of encoded words that a worker of the last stage keeps: less than the default, as the workers have been
#: through the other stages.
CACHE_BYTES = 96 << 20


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the mixing stage has stored the documents, read back.

    A null text has the end id only; every row is written, whatever its id; other columns are ignored."""
    path = shared.new_path(spark, "pipeline-tokens")
    place = docs.metadataColumn("_metadata")  # the hidden column, whatever names docs has
    name = place["file_name"]
    ordered = docs.select("doc_id", "text", F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long").alias("_part"), name.alias("_file"), place["row_index"].alias("_row"))
    parts = token_files.write_token_files(spark, ordered, path, tokenizer_path(), END_ID, order=["_part", "_file", "_row"], cache_bytes=CACHE_BYTES)
    return token_files.read_token_files(spark, path, parts)


STAGES = [("quality classifier", good), ("near-dedup", distinct), ("decontamination", uncontaminated), ("mixing", mixed), ("token files", tokenized)]

#: The classifier and the fingerprints can't be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = shared.new_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


