"""Line dedup by a log-template tree, in DataFrame functions.

A line's tokens are its words, with every run of digits written as 0. The tree has a fixed depth: the
first level is the number of tokens, the next ones are the leading tokens. In a leaf, a position is
constant where one token has more than half of the leaf's lines, and a variable field where none has; a
line belongs to the leaf's template if at least half of its tokens (the leading ones included) are the
template's constants. A leaf holds several templates: the lines that don't fit the first one are a group
with a template of their own, and a group no line of which fits is divided by the tokens of one position.
This is the position where tokens of at least ``min_docs`` lines, but not one token alone, have the most lines (the first
of equals); each such token makes a group, other lines stay together. So ``rounds`` templates are sought along
each way down. Each line is also a template of its own, without variable fields. A generalised
template that occurs in at least ``min_docs`` documents is dropped, everywhere, and so is a line that recurs
as it is (but for digits) in at least ``min_copies``. Lines of fewer than ``min_tokens`` tokens recur by chance:
they are never generalised, and are dropped only if they recur as they are in ``min_docs`` documents. Lines
without tokens stay. Documents are counted by distinct texts, so that copies of a document do not empty it.

Distinct lines are counted before they are compared, and only leaves that enough documents share are
generalised; lines travel as hashes until one of each kind is fetched by its place.

Defined results: a null text is an empty one; rows of equal ids and texts are one document (and each gets
its row; null stands with the id -2^62, which changes no result, as documents are counted by their texts); a text however
long is one row's array of lines and one of each line's tokens; the separators of lines that stay are kept as single line feeds; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import shared

DEPTH = 3
MIN_TOKENS = 4
MIN_DOCS = 10
MIN_COPIES = 3
ROUNDS = 4
SPACE = r"[\x20\x09-\x0D]+"
LEAST = -(1 << 62)


def _tokens(line: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(line, "[0-9]+", "0"), SPACE), lambda x: x != "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("k"), F.xxhash64(text).alias("t"))


def _lines(rows: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """(k, t, line_no, leaf, kind, short): a row for each line with tokens, its leaf and itself as hashes."""
    lines = rows.select("k", "t", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select("k", "t", "line_no", _tokens(F.col("line")).alias("tokens"))
    lines = lines.where(F.size("tokens") > 0)
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf")
    return lines.select("k", "t", "line_no", leaf, F.xxhash64("tokens").alias("kind"), (F.size("tokens") < min_tokens).alias("short"))


def _votes(groups: DataFrame) -> DataFrame:
    """(grp, at, token, n): the lines of each group with this token at this place."""
    return groups.select("grp", "n", F.posexplode("tokens").alias("at", "token")).groupBy("grp", "at", "token").agg(F.sum("n").alias("n"))


def _divided(marked: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """(grp, kind, n, tokens): the groups of the lines that fit no template yet."""
    rest = marked.where(~F.col("fits")).drop("fits")
    whole = marked.groupBy("grp").agg(F.max("fits").alias("peeled"), F.sum("n").alias("all")).where(~F.col("peeled")).drop("peeled")
    often = _votes(rest).where((F.col("at") >= depth) & (F.col("n") >= min_docs)).join(whole, "grp").where(F.col("n") < F.col("all")).drop("all")
    best = often.groupBy("grp", "at").agg(F.sum("n").alias("n")).groupBy("grp").agg(F.max(F.struct("n", (-F.col("at")).alias("before"))).alias("best")).select("grp", (-F.col("best.before")).alias("at"))
    rest = rest.join(best, "grp", "left").withColumn("token", F.get("tokens", F.col("at")))
    rest = rest.join(often.select("grp", "at", "token", F.col("token").alias("own")), ["grp", "at", "token"], "left")
    return rest.select(F.xxhash64("grp", F.coalesce("at", F.lit(-1)), F.col("own").isNotNull(), "own").alias("grp"), "kind", "n", "tokens")


def _templates(spark: SparkSession, found: DataFrame, depth: int, min_docs: int, rounds: int) -> DataFrame:
    """(kind, grp): the lines that fit a generalised template, and which."""
    groups, general = found.withColumnRenamed("leaf", "grp"), []
    for left in range(rounds - 1, -1, -1):
        constant = _votes(groups).groupBy("grp", "at").agg(F.max(F.struct("n", "token")).alias("most"), F.sum("n").alias("all"))
        template = constant.where(F.col("most.n") * 2 > F.col("all")).groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("at", "most.token"))).alias("template"))
        template = shared.write_table(spark, template, "line-constants")
        fixed = F.aggregate(F.transform("tokens", lambda x, i: F.coalesce((F.try_element_at("template", i) == x).cast("int"), F.lit(0))), F.lit(0), lambda a, x: a + x)
        marked = shared.write_table(spark, groups.join(template, "grp", "left").select("grp", "kind", "n", "tokens", (fixed * 2 >= F.size("tokens")).alias("fits")), "line-fits")
        general.append(marked.where("fits").select("kind", "grp"))
        if left:
            groups = shared.write_table(spark, _divided(marked, depth, min_docs), "line-groups")
    return reduce(DataFrame.unionByName, general)


def _general_kinds(spark: SparkSession, rows: DataFrame, lines: DataFrame, depth: int, min_docs: int, rounds: int) -> DataFrame:
    """(kind): the lines of generalised templates that enough documents have."""
    long_lines = lines.where(~F.col("short"))
    # Documents are counted in two steps, each with partial sums: no leaf, however common, is one task's.
    # A kind of line has one leaf, so the kind alone is the key wherever both would be: its rows are then
    # dealt anew; with the leaves in a table of their own, the skewed side of the join by leaf can be split.
    shared_leaves = long_lines.groupBy("leaf", "t").agg(F.lit(1)).groupBy("leaf").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("leaf")
    shared_leaves = shared.write_table(spark, shared_leaves, "line-leaves")
    here = long_lines.join(shared_leaves, "leaf")
    kinds = here.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("leaf").alias("leaf"), F.min(F.struct("k", "t", "line_no")).alias("place"))
    # One line of each kind is fetched from its document.
    wanted = kinds.groupBy(F.col("place.k").alias("k"), F.col("place.t").alias("t")).agg(F.collect_list(F.struct(F.col("place.line_no").alias("line_no"), "leaf", "kind", "n")).alias("wanted"))
    found = rows.select("k", "t", "text").join(wanted, ["k", "t"]).select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("w"))
    found = found.select("w.leaf", "w.kind", "w.n", _tokens(F.col("all")[F.col("w.line_no")]).alias("tokens"))
    found = shared.write_table(spark, found.dropDuplicates(["kind"]), "line-tokens")
    general = shared.write_table(spark, _templates(spark, found, depth, min_docs, rounds), "line-general")
    members = long_lines.select("kind", "t").join(general, "kind")
    recurring = members.groupBy("grp", "t").agg(F.lit(1)).groupBy("grp").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("grp")
    return general.join(shared.write_table(spark, recurring, "line-templates"), "grp").select("kind")


def _dropped(spark: SparkSession, rows: DataFrame, depth: int, min_tokens: int, min_docs: int, min_copies: int, rounds: int) -> DataFrame:
    """(k, t, line_nos): for each document of rows (k, t, text) that loses lines, their numbers from 0."""
    lines = shared.write_table(spark, _lines(rows, depth, min_tokens), "lines")
    exact = lines.groupBy("kind", "t").agg(F.first("short").alias("short")).groupBy("kind").agg(F.count(F.lit(1)).alias("docs"), F.first("short").alias("short"))
    exact = exact.where(F.col("docs") >= F.when(F.col("short"), min_docs).otherwise(min_copies)).select("kind")
    # As a table of its own it is dealt by the join, which can then split a common line's side.
    gone = shared.write_table(spark, exact.unionByName(_general_kinds(spark, rows, lines, depth, min_docs, rounds)).distinct(), "line-recurring")
    return lines.select("k", "t", "line_no", "kind").join(gone, "kind").groupBy("k", "t").agg(F.collect_set("line_no").alias("line_nos"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS, min_copies: int = MIN_COPIES, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): kept is the text without the lines of recurring templates.

    The texts move once, into buckets by document; the two joins that need them read the buckets."""
    documents = shared.write_bucketed(spark, _keyed(docs, id_col, text_col), "line_documents", ["k", "t"])
    dropped = _dropped(spark, documents, depth, min_tokens, min_docs, min_copies, rounds)
    rows = documents.join(dropped, ["k", "t"], "left").withColumn("lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "line_nos")
    kept = F.when(F.col("line_nos").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("line_nos").isNull(), 0).otherwise(F.size("line_nos")).cast("long").alias("n_dropped"), kept.alias("kept"))
