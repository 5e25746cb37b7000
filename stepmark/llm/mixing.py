"""Mixing sources to target weights by capped water-filling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stepmark.llm.common import pick, ranked, through_table

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
BITS = 10
UNIT_BITS = 60


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, size): `share` of all words dealt by weight.

    Sources in code point order (NULL last) get the weights in turn. No target exceeds
    `max_epochs` times its source; what a full source cannot take goes to the others by weight,
    again until no source is above its cap. A round is one sum over the table of sources: the
    water level only rises, so the full sources are those whose cap lies under it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ranked(sources, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = through_table(
        sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        taken, free = sources.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if free is None:  # the share is more than all caps together
            level = float("inf")
            break
        risen = (share * total - (taken or 0)) / free
        if risen <= level:
            break
        level = risen
    target = F.when(F.lit(level) * F.col("weight") < F.col("cap"), F.lit(level) * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def _boundary(blocks: DataFrame, by: list[str], block: str) -> DataFrame:
    """Of each source the block in which its budget `rest` runs out, and what is left for it."""
    before = F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy(block).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        blocks.withColumn("before", before)
        .where("before <= rest and rest < before + n")
        .select(*by, block, (F.col("rest") - F.col("before")).alias("left"))
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole, extra, taken.

    A source with target t and size s takes each of its documents floor(t / s) times whole, and
    in seeded order (md5 of seed and id) once more until its words reach t; the document at that
    point gives only the words still missing (`extra`). So each source meets its target to the
    word, and no document is taken more than `max_epochs` times its size.

    The point where a source runs out is found by block sums (the hash's leading bits, two
    levels of 2**10), so only the rows of one block in 2**20 of a source are sorted together.

    NULL or empty text has size 0 and takes 0; a NULL source is a source of its own, last; rows
    with equal ids or repeated rows count each; an empty table gives no rows.
    """
    key = F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("string")))
    unit = F.conv(F.substring(key, 1, UNIT_BITS // 4), 16, 10).cast("long")
    sizes = pick(docs, doc_id=doc_id, source=source, text=text).select("doc_id", "source", n_words(F.col("text")).alias("size"), unit.alias("unit"))
    sizes = through_table(
        sizes.withColumns(
            {
                "b1": F.shiftright("unit", UNIT_BITS - BITS),
                "b2": F.shiftright("unit", UNIT_BITS - 2 * BITS).bitwiseAND(2**BITS - 1),
            }
        ),
        "sizes",
    )
    sources = source_targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn(
        "budget", F.greatest(F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size"), F.lit(0))
    )
    same = lambda left, right: left["source"].eqNullSafe(right["source"])

    def with_rest(blocks: DataFrame, rests: DataFrame) -> DataFrame:
        return blocks.join(rests, same(blocks, rests)).drop(rests["source"])

    first = with_rest(sizes.groupBy("source", "b1").agg(F.sum("size").alias("n")), sources.select("source", F.col("budget").alias("rest")))
    first = through_table(_boundary(first, ["source"], "b1").withColumnsRenamed({"b1": "at1", "left": "left1"}), "boundary")
    inner = with_rest(sizes, first.select("source", "at1", F.col("left1").alias("rest"))).where("b1 = at1")
    second = inner.groupBy("source", "b2", "rest").agg(F.sum("size").alias("n"))
    second = through_table(_boundary(second, ["source"], "b2").withColumnsRenamed({"b2": "at2", "left": "left2"}), "boundary")

    points = sources.join(first, same(sources, first), "left").drop(first["source"])
    points = points.join(second, same(points, second), "left").drop(second["source"])
    rows = sizes.join(points, same(sizes, points), "left").drop(points["source"])
    here = F.coalesce((F.col("b1") == F.col("at1")) & (F.col("b2") == F.col("at2")), F.lit(False))
    passed = (F.col("b1") > F.col("at1")) | ((F.col("b1") == F.col("at1")) & (F.col("b2") > F.col("at2")))
    outside = rows.where(~here).withColumn("extra", F.when(F.coalesce(passed, F.lit(False)), F.lit(0).cast("long")).otherwise(F.col("size")))
    order = W.partitionBy("source").orderBy("unit", F.col("doc_id").asc_nulls_last(), "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = rows.where(here).withColumn("extra", F.greatest(F.least(F.col("left2") - before, F.col("size")), F.lit(0)))
    return outside.unionByName(inside).select(
        "doc_id", "source", "size", "source_size", "target", "whole", "extra", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: each document as often as it is taken, all columns of `docs` kept.

    A document is repeated `whole` times, and once more if at least half of it is taken extra;
    texts stay whole. Rows with the same id are repeated alike, as often as the most taken of them.
    """
    doc_id = options.get("doc_id", "doc_id")
    plan = mix(docs, **options)
    times = F.col("whole") + F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    # a text without words has no share to take; it is kept once
    times = F.when(F.col("size") == 0, 1).otherwise(times).cast("int").alias("__times")
    plan = plan.select(F.col("doc_id").alias("__id"), times)
    same = plan.groupBy("__id").agg(F.max("__times").alias("__times"))
    joined = docs.join(same, docs[doc_id].eqNullSafe(same["__id"]))
    copies = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return joined.where("__times > 0").withColumn("__copy", copies).select(*docs.columns)
