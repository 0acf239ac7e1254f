"""Document fingerprints: SimHash in DataFrame functions, and permuted block tables to search them.

Terms are the lower-cased words of a whole text. Each occurrence votes on every bit of its term's
64-bit hash with the term's length in characters as its weight; a bit is set where more than half of the
weight has it. The signed sums are not kept in 64 columns: two bits share a long, 32 bits apart, so that
32 sums and the total weight make a fingerprint. No lane overflows, as a string has less than 2^31 characters.

Search: fingerprints within distance k of each other agree on all of b - k of b blocks of bits, for some
choice of them. A table for each choice is keyed by those blocks (a permutation that puts them first);
rows that meet in a table are verified.

Defined results: a null text is an empty one, and a text without words has fingerprint zero; rows are
ordered by id (null first), then text; of rows with equal ids and texts each comes before the next; the
last row's next is the first, so a single document is its own next; other columns are ignored; an empty
table gives no rows. Null stands with the id -2^62 where rows are looked up, but only together with the texts' hashes, so
that what is found is the same. A text however long is held with its edit in one row, and its words in one row's array.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm import ranges

#: Ranges of ranges that one window holds: with ranges.UPPER_BITS, more than any table's.
TOP_BITS = 24
#: Fixed: white space between words.
SPACE = r"[\x20\x09-\x0D]+"


def simhash(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(*keys, fp: long) of rows (*keys, text); rows with equal keys have equal texts, and give one row."""
    words = texts.select(*keys, F.explode(F.split(F.lower(text), SPACE)).alias("word"))
    words = words.select(*keys, F.xxhash64("word").alias("h"), F.char_length("word").cast("long").alias("w"))
    pair = F.lit(1 << 32 | 1)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(pair) * F.col("w")).alias(f"s{i}") for i in range(32)]
    votes = words.groupBy(*keys).agg(F.sum("w").alias("total"), *sums)
    low = F.lit((1 << 32) - 1)
    bit = F.lit(0).cast("long")
    for i in range(32):
        for lane in (0, 32):
            count = F.shiftrightunsigned(f"s{i}", lane).bitwiseAND(low)
            bit = bit.bitwiseOR(F.when(count * 2 > F.col("total"), F.lit(_signed(1 << i + lane))).otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, bit.alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_id, next_text, part), each row beside the next by id.

    Ids are cut into ranges of alike size, whatever their values. The first row of each range is copied, as
    a closing row, to the range before it (the first range's to the last), so every window holds one range
    and no other row moves twice. The range before is found among ranges of ranges."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = ranges.plan(rows, F.col("doc_id"))
    rows = rows.withColumn("part", cut.part(F.col("doc_id")))
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id"), F.col("text"))).alias("first")).withColumn("upper", F.shiftright("part", ranges.UPPER_BITS))
    bounds = firsts.groupBy("upper").agg(F.max("part").alias("last")).withColumn("top", F.shiftright("upper", TOP_BITS))
    before_upper = bounds.withColumn("prior", F.lag("last").over(Window.partitionBy("top").orderBy("upper"))).select("upper", "prior")
    linked = firsts.withColumn("here", F.lag("part").over(Window.partitionBy("upper").orderBy("part"))).join(before_upper, "upper")
    # The very first range has none before it; its first row closes the last range.
    end = firsts.agg(F.max("part")).first()[0]
    closing = linked.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"), F.coalesce("here", "prior", F.lit(end).cast("long")).alias("part"), F.lit(1).alias("closes"))
    both = rows.withColumn("closes", F.lit(0)).unionByName(closing)
    order = Window.partitionBy("part").orderBy("closes", F.col("doc_id").asc_nulls_first(), "text")
    return both.withColumns({"next_id": F.lead("doc_id").over(order), "next_text": F.lead("text").over(order)}).where("closes = 0").drop("closes")


def edited(text: str, following: str) -> Column:
    """The last quarter of a text's characters replaced by the first as many, or all, of another."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - quarter), F.substring(F.col(following), F.lit(1), quarter))


def likeness(a: str, b: str) -> Column:
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / 64


def hexed(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints (fp: as a long) of documents and of their edited texts, and how alike they and the next ones are."""
    paired = with_next(docs, id_col, text_col).withColumn("edit", edited("text", "next_text"))
    id_key = F.coalesce("doc_id", F.lit(-(1 << 62)))
    rows = paired.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
        id_key.alias("k"), F.xxhash64("text").alias("t"), F.xxhash64("edit").alias("e"), F.coalesce("next_id", F.lit(-(1 << 62))).alias("nk"), F.xxhash64("next_text").alias("nt"),
    )
    both = F.array(F.struct(F.xxhash64("text").alias("t"), F.col("text").alias("text")), F.struct(F.xxhash64("edit").alias("t"), F.col("edit").alias("text")))
    texts = paired.select(id_key.alias("k"), F.explode(both).alias("x")).select("k", "x.t", "x.text")
    fps = simhash(texts, ["k", "t"], "text")
    # Keys are ids, so no key is hot; the three lookups are on narrow rows.
    out = rows.join(fps, ["k", "t"]).join(fps.select("k", F.col("t").alias("e"), F.col("fp").alias("edit_fp")), ["k", "e"])
    out = out.join(fps.select(F.col("k").alias("nk"), F.col("t").alias("nt"), F.col("fp").alias("next_fp")), ["nk", "nt"])
    return out.select("doc_id", "n_chars", "edited_sha256", hexed("fp").alias("fingerprint"), hexed("edit_fp").alias("edited_fingerprint"), likeness("fp", "edit_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"), "fp")


def block_tables(radius: int, blocks: int) -> list[int]:
    """The bits of each table's key."""
    if not radius < blocks <= 64:
        raise ValueError("more blocks than the radius are needed")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - radius)]


def find_within(queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(q, fp, distance): for each distinct fingerprint q, those of the corpus within the radius. Both have a column fp."""
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(block_tables(radius, blocks))])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("fp").alias(name)).distinct().select(name, F.explode(tables).alias("x")).select(name, "x.table", F.col(name).bitwiseAND(F.col("x.mask")).alias("key"))

    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("fp")))
    return keyed(queries, "q").join(keyed(corpus, "fp"), ["table", "key"]).where(distance <= radius).select("q", "fp", distance.alias("distance")).distinct()


def documents_within(rows: DataFrame, is_query: Column, radius: int = 3, blocks: int = 6, fp: str = "fp", name: str = "n_within") -> DataFrame:
    """rows with a count: for queries, how many other rows have a fingerprint within the radius; else null.

    The tables hold distinct fingerprints with their numbers of rows, so copies cost nothing."""
    counts = rows.groupBy(F.col(fp).alias("fp")).agg(F.count(F.lit(1)).alias("rows"))
    asked = rows.where(is_query)
    near = find_within(asked.select(F.col(fp).alias("fp")), counts.select("fp"), radius, blocks)
    found = near.join(counts, "fp").groupBy("q").agg((F.sum("rows") - 1).alias(name))
    answered = asked.join(found, asked[fp] == found["q"]).select(*rows.columns, name)
    return answered.unionByName(rows.where(~F.coalesce(is_query, F.lit(False))).withColumn(name, F.lit(None).cast("long")))
