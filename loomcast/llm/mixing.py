"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import packed, whole, words_of
from loomcast.session import settled


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code-point order, null last; a source is taken at
    most ``most_repeats`` times."""

    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    seed: str = "mix"


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Target words per source: shares by weight, capped at ``most_repeats`` times the size.

    ``sizes`` has source and size per document. With sources in ascending order of
    cap / weight, the capped ones are a prefix, and the level of the rest follows from the sums
    before it; this is where repeated resharing of the excess ends. One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in mix.weights]), (place % len(mix.weights) + 1).cast("int"))
    weighed = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * mix.most_repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levelled = weighed.withColumns({"level": level, "place": F.row_number().over(order)})
    # The first source whose own level stays below its cap sets the level of all after it.
    free = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct("place", "level"))
    first_free = levelled.withColumn("free_level", F.min(free).over(everything)["level"])
    return first_free.select(
        "source",
        "source_size",
        F.least(F.coalesce(F.col("free_level") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double")).alias("target"),
    )


def _salt(column: str, mix: Mix) -> Column:
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("null"))))


def _groups(docs: DataFrame, mix: Mix) -> DataFrame:
    """Rows that the mix cannot tell apart, counted, with their places in the order of their source.

    A group has the same doc_id, source and text; nearly every one is a single row. Its rows have
    the positions ``start`` + 1 to ``start`` + n. Groups run in order of size, then of a seeded
    hash of their id, or of their text where they have none. Positions are sums of counts per
    (source, size, first byte of the hash): no source, size or group of copies is ranked in one
    task.
    """
    own = F.md5(F.concat(F.lit(f"{mix.seed}:text:"), whole()))
    measured = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64(whole()).alias("text_hash"),
        F.size(words_of(whole())).cast("long").alias("size"),
        F.when(F.col("doc_id").isNull(), own).otherwise(_salt("doc_id", mix)).alias("salt"),
    )
    key = ["doc_id", "source", "text_hash", "size", "salt"]
    grouped = settled(measured.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = settled(source_targets(grouped.select("source", (F.col("size") * F.col("n")).alias("size")), mix), "mix-targets")
    celled = grouped.withColumn("cell", F.substring("salt", 1, 2))
    counts = celled.groupBy("source", "size", "cell").agg(F.sum("n").alias("n"))
    # Running counts in three levels: over sizes of a source, the 256 cells of a size, and a cell.
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_size.select("source", "size", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("size_start"))
    in_size = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("source", "size", "cell", F.coalesce(F.sum("n").over(in_size), F.lit(0)).alias("cell_start"))
    placed = cells.join(
        starts.withColumnsRenamed({"source": "s1", "size": "z1"}),
        F.col("source").eqNullSafe(F.col("s1")) & (F.col("size") == F.col("z1")),
    ).select(
        F.col("source").alias("s2"), F.col("size").alias("z2"), F.col("cell").alias("c2"),
        (F.col("size_start") + F.col("cell_start")).alias("cell_from"),
    )
    in_cell = Window.partitionBy("source", "size", "cell").orderBy("salt", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    ranked = celled.withColumn("in_cell", F.coalesce(F.sum("n").over(in_cell), F.lit(0)))
    ordered = ranked.join(
        placed, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("cell") == F.col("c2"))
    ).withColumn("start", F.col("cell_from") + F.col("in_cell"))
    offset = F.conv(F.substring(_salt("s3", mix), 1, 8), 16, 10).cast("double") / 4294967296.0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = targets.withColumnRenamed("source", "s3").withColumns({"offset": offset, "ratio": ratio})
    return ordered.join(sources, F.col("source").eqNullSafe(F.col("s3"))).select(
        *key[:4], "n", "start", "ratio", "offset", "source_size", "target"
    )


def _copies(turn: Column, mix: Mix) -> Column:
    """Integers that the running sum crosses at row ``turn`` (from 1) of a group."""
    position = F.col("start") + turn
    crossed = F.floor(position * F.col("ratio") + F.col("offset")) - F.floor((position - 1) * F.col("ratio") + F.col("offset"))
    # Rounding may add a boundary where the ratio is a whole number; the cap holds for documents too.
    return F.least(crossed, F.lit(mix.most_repeats)).cast("long")


def systematic_copies(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How often the mix takes each document.

    Returns doc_id, source, size, source_size, target, copies and taken (copies x size), one row
    per input row. Every document of a source expects target / source_size copies; running sums
    of that, plus one offset per source, are crossed by integers, and a document is emitted once
    per integer. Documents run in order of size, then of a seeded hash of their id, so the words
    taken differ from the target by a few documents at most. Null texts have size 0, a null
    source is a source, null ids are told apart by their texts; an empty table gives no rows.
    Repeated rows count as documents of their own.
    """
    turns = _groups(docs, mix).withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    counted = turns.withColumn("copies", _copies(F.col("turn"), mix))
    return counted.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, with all their columns.

    Every row has its own copies: rows are found again by doc_id, source and text, and rows that
    agree in these take the copies of their group in turn. So what a source emits is what
    ``systematic_copies`` takes of it, whatever ids are null or repeated. An empty table stays
    empty; columns may have any name and type.
    """
    rows = packed(docs).withColumns(
        {"id": F.col("row.doc_id"), "src": F.col("row.source").cast("string"), "hash": F.xxhash64(whole("row.text"))}
    )
    groups = settled(_groups(docs, mix), "mix-taken")
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("src").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("text_hash"))
    carried = ["row", "start", "ratio", "offset"]
    # Groups grow with the documents: a merge join at every size.
    single = rows.join(groups.where("n = 1").hint("merge"), same).select(*carried, F.lit(1).cast("long").alias("turn"))
    repeated = rows.join(groups.where("n > 1").hint("merge"), same).select(*carried, "src", "size", F.spark_partition_id().alias("part"))
    # Written, so that the parts stay what they are; a group is counted and ranked part by part.
    parted = settled(repeated.withColumn("seq", F.monotonically_increasing_id()), "mix-repeated")
    group = ["src", "start"]
    by_part = parted.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        F.col("src").alias("of_src"), F.col("start").alias("of_start"), F.col("part").alias("of_part"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy(*group, "part").orderBy("seq"))
    of_part = F.col("src").eqNullSafe(F.col("of_src")) & (F.col("start") == F.col("of_start")) & (F.col("part") == F.col("of_part"))
    several = parted.withColumn("inside", inside).join(before, of_part).select(*carried, (F.col("before") + F.col("inside")).alias("turn"))
    counted = single.unionByName(several).withColumn("copies", _copies(F.col("turn"), mix)).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")
