"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's shuffled words are cut into equal blocks (lengths differ by one
word at most), and its target is a number of turns, each taking the next block,
cyclically. Slot i of the mix takes the golden-ratio point frac(i / phi); the
point falls into the stretch of one source on the line of cumulative turns, so
every prefix of the mix is close to the targets. A stretch can get a few points
more or less than its turns: points beyond them are left, missing turns are
made up at the end, so each source takes its turns exactly. Only DataFrame
operations are used.

Running sums over a source's documents and slots are taken inside buckets and
joined to the sums of the buckets before, so a source holding most rows is
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, key_of, masked

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 64
LEAST_BLOCKS = 64  # a source of fewer words than this many blocks hold is cut finer, to single words
BUCKET_ROWS = 4096  # documents or slots of a source summed in one window
_POINTS = 2_147_483_647  # points of the golden-ratio lattice
_STEP = 1_327_217_885  # the multiplier nearest to _POINTS / phi
_GRID = 4096  # cells by which slots find the source their point falls to


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than space and U+0009..U+000D (null: 0)."""
    gaps = " \t\n\x0b\x0c\r"
    plain = F.translate(F.col(text).cast("string"), gaps, " " * len(gaps))
    return F.coalesce(F.size(F.array_remove(F.split(plain, " ", -1), "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = MAX_REPEAT) -> DataFrame:
    """Rows (source, key, rank, source_size, target) from one row (source, source_size) per source.

    Sources weigh ``weights``, repeated in code-point order with null last,
    and share the sum of all sizes. A target stops at ``repeat`` times its
    source's size and the excess is shared again by weight until none is
    above: the level that meets the sum is found in the order of cap / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))  # one row per source
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumns({"weight": F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights) + 1),
                                 "cap": F.col("source_size") * repeat})
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    ranked = ranked.withColumns({
        "before": F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "left": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(whole)})
    # a source is capped if, with those below it capped, its share is above its cap
    ranked = ranked.withColumn("open", (F.col("all") - F.col("before")) * F.col("weight") <= F.col("cap") * F.col("left"))
    level = F.max(F.when(F.col("open"), F.struct(-F.col("before"), (F.col("all") - F.col("before")) / F.col("left")))).over(whole)
    target = F.when(F.col("open"), F.col("weight") * level["col2"]).otherwise(F.col("cap")).cast("double")
    return ranked.select("source", "rank", "source_size", F.least(target, F.col("cap").cast("double")).alias("target"))


def _bucketed(rows: DataFrame, scratch: Scratch, name: str, value: Column, order: list[str]) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same rank in earlier buckets or earlier in the own one."""
    rows = rows.withColumn("value", value)
    totals = scratch.table(rows.groupBy("rank", "bucket").agg(F.sum("value").alias("sum")), f"{name}-buckets")
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.table(totals.select("rank", "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base")), f"{name}-base")
    inside = Window.partitionBy("rank", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("inner", F.coalesce(F.sum("value").over(inside), F.lit(0)))
    return inner.join(base, ["rank", "bucket"]).withColumn("before", F.col("base") + F.col("inner")).drop("base", "inner", "bucket", "value")


def turns(goal: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``blocks``, ``short`` (words of a block, the first ``longer`` blocks have one more) and ``turns``."""
    size = F.col("source_size")
    cut = goal.withColumn("blocks", F.greatest(F.ceil(size / block).cast("long"), F.least(size, F.lit(LEAST_BLOCKS)), F.lit(1)))
    cut = cut.withColumns({"short": F.floor(size / F.col("blocks")).cast("long"), "longer": (size % F.col("blocks")).cast("long")})
    passes = F.floor(F.col("target") / size)
    rest, long = F.col("target") - passes * size, F.col("longer") * (F.col("short") + 1)
    last = F.when(rest <= long, rest / (F.col("short") + 1)).otherwise(F.col("longer") + (rest - long) / F.col("short"))
    return cut.withColumn("turns", F.when(size > 0, passes * F.col("blocks") + F.round(last)).otherwise(0).cast("long"))


def schedule(scratch: Scratch, goal: DataFrame) -> DataFrame:
    """Rows (slot, rank, turn): the source of each slot and how many of its slots come before; ``goal`` holds (rank, turns).

    Turns that no point gave are made up in slots after all others.
    """
    spark = goal.sparkSession
    slots = goal.agg(F.sum("turns")).first()[0] or 0
    line = Window.orderBy("rank")
    # the last stretch ends at _POINTS exactly
    edge = F.when(F.row_number().over(line) == F.count(F.lit(1)).over(Window.partitionBy()), F.lit(_POINTS)).otherwise(
        F.least(F.round(F.sum("turns").over(line) / F.lit(float(max(slots, 1))) * _POINTS).cast("long"), F.lit(_POINTS)))
    stretch = goal.select("rank", edge.alias("to")).withColumn("since", F.coalesce(F.lag("to").over(line), F.lit(0)))
    width = -(-_POINTS // _GRID)
    cells = stretch.where("since < to").select("rank", "since", "to", F.explode(F.sequence(
        F.floor(F.col("since") / width), F.floor((F.col("to") - 1) / width))).alias("cell"))
    cells = scratch.table(cells.coalesce(1), "cells")
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % _POINTS * _STEP % _POINTS).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    chosen = points.join(cells, "cell").where("point >= since AND point < to").select(
        "slot", "rank", F.floor(F.col("slot") / BUCKET_ROWS).alias("bucket"))
    given = _bucketed(chosen, scratch, "slots", F.lit(1), ["slot"]).select("slot", "rank", F.col("before").alias("turn"))
    given = scratch.table(given.join(goal.select("rank", "turns"), "rank").where("turn < turns").select("slot", "rank", "turn"), "given")
    have = given.groupBy("rank").agg(F.count(F.lit(1)).alias("have"))
    missing = goal.join(have, "rank", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < turns").select(
        "rank", F.explode(F.sequence(F.col("have"), F.col("turns") - 1)).alias("turn"))
    return given.unionByName(missing.select((F.lit(slots) + F.col("turn")).alias("slot"), "rank", "turn"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = MAX_REPEAT, block: int = BLOCK_WORDS) -> DataFrame:
    """Rows (doc_id, row, size, source_size, target, taken), one per row of ``docs`` (doc_id, text, source).

    ``row`` is the hash of the text. ``taken`` counts the words of the row that the mix takes, repeats counted;
    a row is taken ``repeat`` times at most. A source's sum is its target to half a block's words. Null and empty texts have size
    and taken 0. A null source is a source of its own, ranked last. Repeated
    rows and null ids stay and are shuffled by what they hold, so reruns agree.
    Only doc_id, text and source are read; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"),
                       F.xxhash64(F.col("text").cast("string")).alias("row"))
    rows = scratch.table(rows.withColumn("shuffle", F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("row"))), "sizes")
    per_source = scratch.table(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).repartition(1), "per-source")
    goal = scratch.table(targets(per_source.select("source", "source_size"), weights, repeat).join(
        per_source.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s").repartition(1), "goal")
    total = goal.agg(F.sum("source_size")).first()[0] or 0
    mine = rows.withColumnRenamed("source", "s").join(goal, F.col("s").eqNullSafe(F.col("source"))).drop("s", "source")
    # the shuffled order of a source: its hashes, cut into ranges of about BUCKET_ROWS rows
    cuts = F.ceil(F.col("n") / BUCKET_ROWS)
    spread = F.shiftrightunsigned(F.col("shuffle"), 33)
    mine = mine.withColumn("bucket", F.floor(spread * cuts / F.lit(1 << 31)))
    placed = scratch.table(_bucketed(mine, scratch, "docs", F.col("size"), ["shuffle", "doc_id", "row"]).drop("shuffle", "n"), "placed")
    if not total:
        return placed.select("doc_id", "row", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    goal = scratch.table(turns(goal.select("rank", "source_size", "target"), block).repartition(1), "turns")
    blocks = goal.select("rank", "blocks", "short", "longer")
    taken = schedule(scratch, goal.select("rank", "turns")).join(blocks, "rank").groupBy(
        "rank", (F.col("turn") % F.col("blocks")).alias("block")).agg(F.count(F.lit(1)).alias("times"))
    taken = scratch.table(taken, "taken-blocks")
    # pieces of documents by block, and how often the schedule takes the block
    step = F.col("short") + 1
    edge = F.col("longer") * step  # words in the longer blocks

    def block_of(word: Column) -> Column:
        return F.when(word < edge, F.floor(word / step)).otherwise(F.col("longer") + F.floor((word - edge) / F.col("short")))

    def start_of(number: Column) -> Column:
        return number * F.col("short") + F.least(number, F.col("longer"))

    end = F.col("before") + F.col("size")
    pieces = placed.where("size > 0").join(blocks, "rank").select(
        "rank", "before", "size", "short", "longer", F.explode(F.sequence(block_of(F.col("before")), block_of(end - 1))).alias("block"))
    overlap = F.least(end, start_of(F.col("block") + 1)) - F.greatest(F.col("before"), start_of(F.col("block")))
    of_doc = scratch.table(pieces.join(taken, ["rank", "block"]).groupBy("rank", "before").agg(F.sum(overlap * F.col("times")).alias("taken")), "taken")
    out = placed.join(of_doc.withColumnsRenamed({"rank": "r", "before": "b"}),
                      (F.col("rank") == F.col("r")) & (F.col("before") == F.col("b")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: each whole text as often as its taken share, rounded; the columns of ``docs``.

    Only the documents at either end of a source's last pass are taken in
    part, so rounding moves a source by less than two documents. Rows without
    words go. Rows that repeat an id and a text are taken equally often.
    """
    taken = mix(docs, **options).where("size > 0").groupBy("doc_id", "row").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_copies")).where("_copies > 0")
    taken = taken.select(key_of("doc_id").alias("_key"), F.col("row").alias("_row"), "_copies")
    rows, names = masked(docs, "doc_id", "text")
    keyed = rows.withColumns({"_key": key_of("doc_id"), "_row": F.xxhash64(F.col("text").cast("string"))})
    return keyed.join(taken, ["_key", "_row"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        *names).toDF(*docs.columns)
