"""Near-duplicates by SimHash and by the Jaccard similarity of shingle sets: what the SimHash links miss.

SimHash fingerprints within 3 of 64 bits stand for a similarity of about 0.95, so by themselves they miss
nine in ten pairs at 0.8. This module takes the SimHash links of ``simhash_dedup`` and adds those of texts
whose sets of shingles have a Jaccard similarity of at least ``least``, which is computed from the texts of
every candidate pair. Candidates agree in all ROWS values of one of BANDS bands of MinHash values: a pair
of similarity s is missed with probability (1 - s^ROWS)^BANDS, which at 0.8 is 7 in 100,000 and less above.
Fingerprints and MinHash values come from one pass over the texts, and all links meet in one table.

Texts of equal sets are one node. Members of a band's bucket are compared with its least and its largest
member; then those pairs are compared whose members are in different components still, so that a large
group of copies costs no square of its size, and no candidate pair that could change a component is left
out. Such a pair is one only if 480 MinHash values make its similarity 0.76 or more, and only in the first
bucket that its members share; the join itself looks at both (by calculation the estimate is below that for
one pair in 60 at a similarity of 0.8, one in 3,000 at 0.82, one in a million at 0.85). What is left grows
with the square of a group only for texts that are about 0.76 to 0.8 alike and in different components.

Defined results: texts without words have an empty set and fingerprint zero, so that they are linked if
SimHash is asked for, and give no row if not; a null doc_id is a component id only where no other id is
in the component; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import blobs, shared
from lumenfold.llm.components import connected_components
from lumenfold.llm.simhash_dedup import SEED, fingerprint, fingerprint_links, shingles

ROWS, BANDS = 5, 24
#: MinHash values of a text; those beyond the bands' only sharpen the estimate of a pair's similarity.
VALUES = 480
#: Four bits of each value are kept.
LONGS = VALUES // 16
#: The share of the kept MinHash values that a pair must have in common before its texts are compared. At a
#: similarity s it is s + (1 - s) / 16 on average, as unequal values agree in four bits once in 16.
LEAST_ALIKE = 0.775
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, VALUES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
LEAST_ID = -(1 << 62)
SKETCH = "doc_id long, k long, t long, sig long, fp long, mins array<long>, bands array<long>"


def minhashes(hashes: np.ndarray) -> np.ndarray:
    out = np.full(len(FACTORS), (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(out, (hashes[at : at + 1024, None] * FACTORS).min(axis=0), out=out)
    return out


def _band_keys(mins: np.ndarray) -> np.ndarray:
    """Rows of MinHash values -> rows of one key a band."""
    rows = mins[:, : BANDS * ROWS].reshape(len(mins), BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(mins), 1))
    for i in range(ROWS):
        keys = blobs.mix(keys ^ rows[:, :, i])
    return keys.view(np.int64)


def text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    doc_id = F.col(id_col).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LEAST_ID)).alias("k"), text_hash(text).alias("t"), text.alias("text"))


def _sketch(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs, fps, mins = np.zeros(b.num_rows, np.uint64), np.zeros(b.num_rows, np.uint64), []
            has = np.zeros(b.num_rows, bool)
            for i, text in enumerate(b.column(3).cast(pa.binary())):
                hashes = shingles(text.as_py() or b"", words)
                fps[i] = fingerprint(hashes)
                found = np.unique(hashes)
                sigs[i] = xxhash.xxh64_intdigest(found.tobytes(), SEED)
                if len(found):
                    has[i] = True
                    mins.append(minhashes(found))
            values = np.stack(mins) if mins else np.zeros((0, len(FACTORS)), np.uint64)
            # Four bits of each value tell most unequal ones apart; sixteen make a long.
            low = blobs.mix(values).astype(np.uint8)
            low = np.ascontiguousarray(low[:, ::2] & 15 | low[:, 1::2] << 4).view(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * x.shape[1])]).astype(np.int32)), pa.array(x.ravel())) for x in (low, _band_keys(values))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sigs.view(np.int64)), pa.array(fps.view(np.int64)), *lists], ["doc_id", "k", "t", "sig", "fp", "mins", "bands"])
        shared.trim()

    return sketch


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _verify(words: int, least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, heads = None, np.zeros(0, np.uint64)
        for b in batches:
            keep = []
            for v, x, y in zip(b.column(1), b.column(2).cast(pa.binary()), b.column(3).cast(pa.binary())):
                if v != last:  # many pairs in a row have one head
                    last, heads = v, np.unique(shingles(y.as_py(), words))
                keep.append(jaccard(np.unique(shingles(x.as_py(), words)), heads) >= least)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        shared.trim()

    return verify


def unlike(a: Column, b: Column) -> Column:
    """How many groups of four bits differ of two arrays of LONGS longs."""
    total = F.lit(0)
    for i in range(LONGS):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for shift, mask in ((2, 0x33), (1, 0x11)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask * 0x0101010101010101))
        total = total + F.bit_count(x)
    return total


def _compare(spark: SparkSession, pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar."""
    both = pairs.select("u", "v").join(texts.select(F.col("sig").alias("u"), F.col("text").alias("x")), "u").join(texts.select(F.col("sig").alias("v"), F.col("text").alias("y")), "v")
    return shared.write_table(spark, both.select("u", "v", "x", "y").mapInArrow(_verify(words, least), "u long, v long"), "band-links")


def _simhash_edges(spark: SparkSession, rows: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between nodes whose fingerprints are within the radius."""
    heads = shared.write_table(spark, rows.groupBy("fp").agg(F.min("sig").alias("head")), "fp-heads")
    same = rows.select("fp", "sig").distinct().join(heads, "fp").where("sig != head").select(F.col("sig").alias("u"), F.col("head").alias("v"))
    near = fingerprint_links(spark, heads, radius)
    far = near.join(heads.select(F.col("fp").alias("u"), F.col("head").alias("a")), "u").join(heads.select(F.col("fp").alias("v"), F.col("head").alias("b")), "v")
    return same.unionByName(far.select(F.col("a").alias("u"), F.col("b").alias("v")))


def groups(spark: SparkSession, docs: DataFrame, words: int = 5, least: float = 0.8, radius: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t: hash of the text, component_id: least doc_id reachable over links of similar sets and,
    if a radius is given, of fingerprints within it)."""
    keyed = _keyed(docs, id_col, text_col)
    rows = shared.write_table(spark, keyed.mapInArrow(_sketch(words), SKETCH), "sketches")
    if radius is None:
        rows = rows.where(F.size("bands") > 0)
    links = shared.write_table(spark, _simhash_edges(spark, rows, radius), "fp-links") if radius is not None else spark.createDataFrame([], "u long, v long")
    nodes = shared.write_table(spark, rows.groupBy("sig").agg(F.min("doc_id").alias("least"), F.min(F.struct("k", "t")).alias("place"), F.first("bands").alias("bands"), F.first("mins").alias("mins")), "sketch-nodes")
    banded = nodes.select("sig", F.posexplode("bands").alias("band", "key"))
    # Tables of their own are dealt by the joins, which can then split a common key's side.
    common = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("sig").alias("low"), F.max("sig").alias("high")).where("n > 1").drop("n")
    common = shared.write_table(spark, common, "band-keys")
    members = shared.write_table(spark, banded.join(common, "key"), "band-members")
    wanted = members.select("sig").distinct().join(nodes, "sig").select("sig", F.col("place.k").alias("k"), F.col("place.t").alias("t"))
    texts = shared.write_table(spark, keyed.join(wanted, ["k", "t"]).select("sig", "text").dropDuplicates(["sig"]), "band-texts")
    ends = members.select("sig", F.explode(F.array("low", "high")).alias("end")).where("sig != end")
    pairs = ends.select(F.greatest("sig", "end").alias("u"), F.least("sig", "end").alias("v")).distinct()
    pairs = shared.write_table(spark, pairs, "band-pairs")
    links = links.unionByName(_compare(spark, pairs, texts, words, least))
    roots = connected_components(spark, links)
    # What is left in buckets with several components: pairs across them that were not compared.
    placed = members.join(roots, members["sig"] == roots["node"], "left").select("key", "band", "sig", F.coalesce("root", "sig").alias("c"))
    placed = shared.write_table(spark, placed, "band-placed")
    mixed = shared.write_table(spark, placed.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("z")).where("a < z").select("key"), "band-mixed")
    split = placed.join(mixed, "key").join(nodes.select("sig", "mins", "bands"), "sig").select("key", "band", "sig", "c", "mins", "bands")
    split = shared.write_table(spark, split, "band-split")
    other = split.select("key", F.col("sig").alias("v"), F.col("c").alias("d"), F.col("mins").alias("others"), F.col("bands").alias("keys"))
    alike = (F.col("c") < F.col("d")) & (unlike(F.col("mins"), F.col("others")) <= int((1 - LEAST_ALIKE) * VALUES))
    for i in range(BANDS - 1):  # not if an earlier band agrees, too
        alike = alike & ((F.col("band") <= i) | (F.get("bands", F.lit(i)) != F.get("keys", F.lit(i))))
    across = split.join(other, (split["key"] == other["key"]) & alike).select(F.greatest("sig", "v").alias("u"), F.least("sig", "v").alias("v"), "c", "d")
    across = across.join(pairs, ["u", "v"], "left_anti")
    across = shared.write_table(spark, across, "band-across")
    more = across.join(_compare(spark, across, texts, words, least), ["u", "v"]).select(F.col("c").alias("u"), F.col("d").alias("v"))
    # The rest of the links join whole components, so only those are looked at again.
    upper = connected_components(spark, more).select(F.col("node").alias("top"), F.col("root").alias("above"))
    joined = nodes.join(roots, nodes["sig"] == roots["node"], "left").select("sig", "least", F.coalesce("root", "sig").alias("top"))
    joined = joined.join(upper, "top", "left").select("sig", "least", F.coalesce("above", "top").alias("root"))
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("doc_id", "t", "sig").join(joined.join(ids, "root").select("sig", "component_id"), "sig").select("doc_id", "t", "component_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, least: float = 0.8, radius: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) of groups()."""
    return groups(spark, docs, words, least, radius, id_col, text_col).drop("t")


def keep_one(spark: SparkSession, docs: DataFrame, words: int = 5, radius: int = 3, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, without those that have a near-duplicate of smaller id.

    Only ids and hashes of the texts that go are joined with docs; the hash tells rows apart that share an
    id but not a group. Rows without an id go only if their group has one with an id; rows that share the
    least id of their group stay."""
    found = groups(spark, docs, words, least, radius, id_col, text_col)
    gone = found.where(F.coalesce(F.col("component_id") < F.col("doc_id"), F.col("component_id").isNotNull()))
    gone_id, gone_t = shared.free_name(docs, "gone_id"), shared.free_name(docs, "gone_t")
    gone = shared.write_table(spark, gone.select(F.col("doc_id").alias(gone_id), F.col("t").alias(gone_t)).distinct(), "near-duplicates")
    here = F.col(id_col).cast("long").eqNullSafe(F.col(gone_id))
    return docs.join(gone, here & (text_hash(F.col(text_col).cast("string")) == F.col(gone_t)), "left_anti")
