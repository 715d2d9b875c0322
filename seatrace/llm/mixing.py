"""Mix sources to target weights: repeat whole documents, one seeded draw for the rest.

Native DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, words

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds this many times all words.
SHARE = 1.5
#: A source is repeated at most this often.
MOST = 2.0
SEED = "mix-1"
#: A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 50_000


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """source, source_size and target for ``sizes`` (source, source_size).

    With the sources in order of cap over weight, the first ones are full. The level that
    the others get per weight follows from running sums; it is the level at the first
    source whose cap it does not exceed. The windows run over one row per source.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    caps = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    ).withColumn("cap", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    levels = caps.withColumn("level", left / open_weight).withColumn(
        "fits", F.col("level") * F.col("weight") <= F.col("cap")
    )
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(
        everything
    )["level"]
    return levels.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.col("cap")).alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """``_doc`` (the row of ``docs``), size, source_size, target and copies of every row.

    Size counts words; a null text has none. A null source is a source of its own, last in
    order. A source without words gets target 0 and no copies. Copies are floor(rate) plus
    one with the fraction's probability, drawn from doc_id (from the text where doc_id is
    null), so repeated rows are taken alike. ``carry`` limits the columns kept in ``_doc``.
    """
    size = F.size(words(F.col("text"))).cast("long")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))))
    rows = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("_doc"),
        F.col("source").cast("string").alias("_source"),
        size.alias("size"),
        uniform(key, seed).alias("_draw"),
    )
    sizes = docs.select(F.col("source").cast("string").alias("source"), size.alias("size"))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(totals, weights, share, most))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = F.when(F.col("_draw") < rate - F.floor(rate), 1).otherwise(0)
    return rows.join(targets, F.col("_source").eqNullSafe(F.col("source"))).select(
        "_doc", "size", "source_size", "target", (F.floor(rate) + extra).alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it."""
    plan = mix_plan(docs, **options).filter("copies > 0")
    copies = plan.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return copies.select("_doc.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row."""
    return mix_plan(docs, carry=["doc_id"], **options).select(
        "_doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )
