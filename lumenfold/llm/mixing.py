"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in ascending id, are cut into blocks. With integer weights w that sum to W, a
source's block j (from 0) is released at slot floor(j * W / w) and due by slot ceil((j + 1) * W / w). In
every slot the earliest deadline among the released blocks goes first (ties: the larger weight, then the
first source by name). On one processor with full use this meets every deadline, so no source is ever a
whole block ahead of or behind its share. The schedule repeats after W slots, so one cycle is computed.

Sources of one weight have the same windows and take turns by name, so the cycle is scheduled by weight,
however many sources there are: a fold over the slots, a page of PAGE_SLOTS at a time, each page written
to the shared folder. There is no bound on sources or slots; with one weight alone no fold is needed.

Every document stays: the shares hold until a source runs out, then its slots fall empty and the rest
goes on in the same order. All is DataFrame functions. Ranks within a source come from prefix sums over
ranges of ids, so a source with most of the rows is spread like any other.

Defined results: a null source is a source of its own, first by name; null ids come first in their
source; rows that share an id are ordered by the columns named as ties, and rows equal in those in any
order; sources without a given weight have weight 1; an empty table gives no rows. Other columns are kept,
whatever their names; mix() adds columns, which replace those of the same names, interleave() adds none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm import ranges, shared

BLOCK = 16
#: Slots of a cycle that one fold schedules.
PAGE_SLOTS = 4096
#: Blocks that one row lists; a longer run of blocks is cut into rows first.
LISTED_BLOCKS = 1 << 14
#: Slots that are summed at once in prefix sums over slots, as a power of two.
SUM_BITS = 15
ADDED = ("block", "slot", "release", "deadline", "position")


def _div(x: Column, y: Column) -> Column:
    """Integer quotient of numbers that are not negative."""
    return ((x - x % y) / y).cast("long")


def _before(value: str, by: list[str], order: str) -> Column:
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _named(source: Column) -> dict[str, Column]:
    """A source as two columns without nulls, so that joins find rows where windows have put them."""
    return {"_source": F.coalesce(source, F.lit("")), "_named": source.isNotNull()}


SOURCE = ["_source", "_named"]


def packed(docs: DataFrame, id_col: str, source_col: str, ties: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """(_doc: all columns, _id, _source, _named, _range, _tie0, ...): no column of docs can clash. Also the sort order."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("_s"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)])
    cut = ranges.plan(docs, F.col(id_col))
    rows = rows.withColumns({**_named(F.col("_s")), "_range": cut.part(F.col("_id"))}).drop("_s")
    return rows, ["_id", *(f"_tie{i}" for i in range(len(ties)))]


def weigh(pieces: DataFrame, weights: dict[str | None, int] | None) -> DataFrame:
    """(_source, _named, _w, _n) of the sources of pieces (_source, _named, _n)."""
    if any(w < 1 or w != int(w) for w in (weights or {}).values()):
        raise ValueError("weights are positive integers")
    w = F.lit(1).cast("long")
    for name, weight in (weights or {}).items():
        w = F.when((F.col("_named") == F.lit(name is not None)) & (F.col("_source") == F.lit(name or "")), F.lit(int(weight)).cast("long")).otherwise(w)
    return pieces.groupBy(*SOURCE).agg(F.sum("_n").alias("_n")).withColumn("_w", w)


def members(spark, sources: DataFrame) -> DataFrame:
    """sources with _member: the place of a source among those of its weight, by name. Names are cut into
    ranges by their hash-free first bytes, so that a million sources of one weight are no one task."""
    head = F.conv(F.rpad(F.hex(F.substring(F.encode("_source", "utf-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    cut = ranges.plan(sources, head)
    rows = sources.withColumn("_range", F.when(F.col("_named"), cut.part(head)).otherwise(F.lit(0))).withColumn("_upper", F.shiftright("_range", ranges.UPPER_BITS))
    rows = shared.write_table(spark, rows, "mix-sources")
    counts = rows.groupBy("_w", "_upper", "_range").agg(F.count(F.lit(1)).alias("_c"))
    upper = counts.groupBy("_w", "_upper").agg(F.sum("_c").alias("_m")).withColumn("_start", _before("_m", ["_w"], "_upper")).drop("_m")
    counts = counts.withColumn("_inner", _before("_c", ["_w", "_upper"], "_range")).join(upper, ["_w", "_upper"]).select("_w", "_range", (F.col("_start") + F.col("_inner")).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_w", "_range").orderBy("_named", "_source")) - 1
    return rows.withColumn("_place", place).join(counts, ["_w", "_range"]).select(*SOURCE, "_n", "_w", (F.col("_first") + F.col("_place")).alias("_member"))


def _page(spark, classes: list[tuple[int, int]], total: int, done: list[int], first: int, stop: int) -> DataFrame:
    """(_slot, _i, _q): the class and its job in each slot of [first, stop), given the jobs done before."""
    listed = F.array(*[F.struct(F.lit(w).cast("long").alias("w"), F.lit(m).cast("long").alias("m")) for w, m in classes])
    rows = spark.range(1).select(listed.alias("c"), F.array(*[F.lit(d).cast("long") for d in done]).alias("done"))
    c, whole = F.col("c"), F.lit(total).cast("long")

    def step(acc: Column, slot: Column) -> Column:
        def offer(x: Column, i: Column) -> Column:
            j = _div(acc["done"][i], x["m"])
            return F.when((j < x["w"]) & (_div(j * whole, x["w"]) <= slot), F.struct(_div((j + 1) * whole + x["w"] - 1, x["w"]).alias("deadline"), (-x["w"]).alias("heavy"), i.alias("i"), acc["done"][i].alias("q")))

        # The pick is found once: a one-element array carries it to where it is used. Nulls are passed over.
        return F.element_at(
            F.transform(
                F.array(F.array_min(F.transform(c, offer))),
                lambda p: F.struct(F.transform(acc["done"], lambda d, i: d + (i == p["i"]).cast("long")).alias("done"), F.concat(acc["out"], F.array(F.struct(slot.alias("slot"), p["i"].alias("i"), p["q"].alias("q")))).alias("out")),
            ),
            1,
        )

    zero = F.struct(F.col("done"), F.expr("CAST(array() AS array<struct<slot:bigint,i:int,q:bigint>>)").alias("out"))
    slots = F.sequence(F.lit(first).cast("long"), F.lit(stop - 1).cast("long"))
    return rows.select(F.explode(F.aggregate(slots, zero, step, lambda a: a["out"])).alias("o")).select(F.col("o.slot").alias("_slot"), F.col("o.i").alias("_i"), F.col("o.q").alias("_q"))


def schedule(spark, classes: list[tuple[int, int]], page: int = PAGE_SLOTS) -> DataFrame:
    """(_w, _q, _slot) for one cycle of classes (weight, number of sources): job q of a class is block
    q div m of its source q mod m. What the driver holds is one number for each distinct weight."""
    total = sum(w * m for w, m in classes)
    if len(classes) <= 1:
        return spark.range(total).select(F.lit(classes[0][0] if classes else 1).cast("long").alias("_w"), F.col("id").alias("_q"), F.col("id").alias("_slot"))
    path, done = shared.new_path(spark, "mix-cycle"), [0] * len(classes)
    for first in range(0, total, page):
        _page(spark, classes, total, done, first, min(total, first + page)).write.mode("append").parquet(path)
        if first + page < total:
            seen = spark.read.parquet(path).where(F.col("_slot") >= first).groupBy("_i").agg(F.max("_q").alias("q")).collect()
            for r in seen:
                done[r["_i"]] = r["q"] + 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w, _ in classes]), F.col("_i") + 1)
    return spark.read.parquet(path).select(weight.alias("_w"), "_q", "_slot")


def _slots(rows: DataFrame, cycle: DataFrame, total: int, block: Column) -> DataFrame:
    """rows (of sources with _w, _m, _member) with slot, release and deadline of a block; the cycle's
    table is joined by its size as written."""
    w = F.col("_w")
    rows = rows.withColumn("_block", block).withColumns({"_cycle": _div(F.col("_block"), w), "_j": F.col("_block") % w})
    rows = rows.withColumn("_q", F.col("_j") * F.col("_m") + F.col("_member")).join(cycle, ["_w", "_q"])
    base, whole = F.col("_cycle") * total, F.lit(total).cast("long")
    return rows.withColumns({"_slot": base + F.col("_slot"), "_release": base + _div(F.col("_j") * whole, w), "_deadline": base + _div((F.col("_j") + 1) * whole + w - 1, w)}).drop("_cycle", "_j", "_q")


def running_sums(sizes: DataFrame, key: str, value: str) -> DataFrame:
    """(key, _start): the sum of the values of smaller keys; keys are distinct and not negative. Sums are
    taken in groups of keys, then of groups, so no window holds more than 2^SUM_BITS rows."""
    level, levels = sizes.select(F.col(key).alias("k0"), F.col(value).alias("v")), []
    for i in range(-(-63 // SUM_BITS)):
        level = level.withColumn(f"k{i + 1}", F.shiftright(f"k{i}", SUM_BITS))
        levels.append(level.select(f"k{i}", f"k{i + 1}", _before("v", [f"k{i + 1}"], f"k{i}").alias(f"s{i}")))
        level = level.groupBy(f"k{i + 1}").agg(F.sum("v").alias("v"))
    out = levels[-1].drop(f"k{len(levels)}")
    for i in reversed(range(len(levels) - 1)):
        out = levels[i].join(out, f"k{i + 1}").select(f"k{i}", (F.col(f"s{i}") + F.col(f"s{i + 1}")).alias(f"s{i}"))
    return out.select(F.col("k0").alias(key), F.col("s0").alias("_start"))


def _scheduled(docs: DataFrame, weights: dict[str | None, int] | None, block: int, id_col: str, source_col: str, ties: tuple[str, ...], positions: bool) -> DataFrame:
    """Packed rows with _rank, _block, _slot, _release, _deadline, and _start (of the slot) if positions are asked for."""
    spark = docs.sparkSession
    rows, order = packed(docs, id_col, source_col, ties)
    keys = ["_range", *SOURCE]
    counts = shared.write_table(spark, rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "mix-counts")
    sources = shared.write_table(spark, members(spark, weigh(counts, weights)), "mix-members")
    classes = [(r["_w"], r["m"]) for r in sources.groupBy("_w").agg(F.count(F.lit(1)).alias("m")).orderBy("_w").collect()]
    total = sum(w * m for w, m in classes)
    cycle = schedule(spark, classes)
    many = F.lit(1).cast("long")
    for w, m in classes:
        many = F.when(F.col("_w") == w, F.lit(m).cast("long")).otherwise(many)
    # Ranges of ranges keep the running sum of a large source from being one long task.
    counts = counts.withColumn("_upper", F.shiftright("_range", ranges.UPPER_BITS))
    upper = counts.groupBy("_upper", *SOURCE).agg(F.sum("_n").alias("_c")).withColumn("_first", _before("_c", SOURCE, "_upper")).drop("_c")
    inner = counts.withColumn("_inner", _before("_n", [*SOURCE, "_upper"], "_range"))
    bases = inner.join(upper, ["_upper", *SOURCE]).join(sources.select(*SOURCE, "_w", "_member"), SOURCE)
    bases = bases.select(*keys, "_n", (F.col("_first") + F.col("_inner")).alias("_base"), "_w", "_member", many.alias("_m"))
    bases = shared.write_table(spark, bases, "mix-bases")
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = rows.withColumn("_row", F.row_number().over(window) - 1).select("_doc", *keys, "_row")
    placed = placed.join(bases.drop("_n"), keys).withColumn("_rank", F.col("_base") + F.col("_row"))
    placed = _slots(placed.select("_doc", "_rank", "_w", "_member", "_m"), cycle, total, _div(F.col("_rank"), F.lit(block)))
    if not positions:
        return placed
    # How many documents each slot has, from the counts alone: the blocks that each range's rows are in.
    low, high = _div(F.col("_base"), F.lit(block)), _div(F.col("_base") + F.col("_n") - 1, F.lit(block))
    runs = bases.withColumns({"_low": low, "_high": high}).withColumn("_from", F.explode(F.sequence(F.col("_low"), F.col("_high"), F.lit(LISTED_BLOCKS).cast("long"))))
    runs = runs.withColumn("_b", F.explode(F.sequence(F.col("_from"), F.least(F.col("_high"), F.col("_from") + (LISTED_BLOCKS - 1)))))
    size = F.least((F.col("_b") + 1) * block, F.col("_base") + F.col("_n")) - F.greatest(F.col("_b") * block, F.col("_base"))
    sizes = _slots(runs.withColumn("_size", size), cycle, total, F.col("_b")).groupBy("_slot").agg(F.sum("_size").alias("_size"))
    starts = running_sums(shared.write_table(spark, sizes, "mix-sizes"), "_slot", "_size")
    return placed.join(shared.write_table(spark, starts, "mix-starts"), "_slot")


def mix(docs: DataFrame, weights: dict[str | None, int] | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", ties: tuple[str, ...] = ("text",)) -> DataFrame:
    """docs with block (of its source), slot (over all cycles), release, deadline and position.

    position numbers all documents from 0 without gaps, in schedule order; it comes from prefix sums over
    the slots, not from a global sort."""
    rows = _scheduled(docs, weights, block, id_col, source_col, ties, True)
    out = {"block": F.col("_block"), "slot": F.col("_slot"), "release": F.col("_release"), "deadline": F.col("_deadline"), "position": F.col("_start") + F.col("_rank") % block}
    kept = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c.lower() not in ADDED]
    return rows.select(*kept, *[x.alias(c) for c, x in out.items()])


def interleave(docs: DataFrame, weights: dict[str | None, int] | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", ties: tuple[str, ...] = ("text",)) -> DataFrame:
    """docs, with their own columns alone, sorted in schedule order."""
    rows = _scheduled(docs, weights, block, id_col, source_col, ties, False)
    return rows.orderBy("_slot", "_rank").select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
