"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the word budget in proportion to its weight. No source may be repeated more
than `max_epochs` times: where its share is above that it is clamped, and the excess goes to the others by weight,
until none is above. The fixed point is one level L with target = min(cap, L * weight), found in closed form from
running sums over the sources in the order of cap / weight.

A source's target of k whole epochs and a rest is met by k copies of each document and one more copy of those that
come first in a seeded order, until the rest is used up. The order is never sorted as a whole: sums per
(source, hash bin) locate the bin in which the rest ends, and only documents within one bin are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, words

BINS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """(src, src_null, source_size) to the same with `target`.

    Sources in code point order, null last, take the weights in turn. One row per source, so the unpartitioned windows
    hold as many rows as there are sources.
    """
    by_name = Window.orderBy("src_null", "src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    s = sizes.withColumn("weight", weight).withColumns({"cap": F.col("source_size") * F.lit(float(max_epochs)), "budget": F.sum("source_size").over(everything) * F.lit(float(share))})
    s = s.withColumn("level", F.col("cap") / F.col("weight"))
    up_to = Window.orderBy("level", "src_null", "src").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumns({"caps": F.sum("cap").over(up_to), "rest": F.sum("weight").over(everything) - F.sum("weight").over(up_to)})
    s = s.withColumn("clamped", F.col("caps") + F.col("level") * F.col("rest") <= F.col("budget"))
    free = F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(everything)
    held = F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0.0))
    s = s.withColumn("filled", F.when(F.col("clamped"), F.col("cap")).otherwise((F.col("budget") - held) / free * F.col("weight")))
    return s.select("src", "src_null", "source_size", F.col("filled").alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.0, max_epochs: float = 3.0, seed: int = 17, row: str | None = None) -> DataFrame:
    """How often the mix takes each document: doc_id, size, source_size, target, taken, copies; one row per document.

    `share` of all words is the budget. Null text has size 0; documents of size 0 take no words. A null source is a source of
    its own, the last one. Repeated rows are documents of their own; a null doc_id is a value like another. An empty
    table gives an empty plan. `row` names a column that tells rows apart; it orders those that are alike and is given back.
    max_epochs is a whole number, another is refused: a document comes max_epochs times at most. Rows of one doc_id are ordered in one task.
    """
    if max_epochs != int(max_epochs) or max_epochs < 1:
        raise ValueError(f"max_epochs must be a whole number of epochs, not {max_epochs}")
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    keys = [row] if row else []
    base = staged(
        docs.select("doc_id", *keys, F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("src_null"), words(F.col("text")).alias("size"), h.alias("h")).withColumn("bin", F.col("h") % BINS),
        "mix",
    )
    bins = base.groupBy("src", "src_null", "bin").agg(F.sum("size").alias("bin_size"))
    targets = source_targets(bins.groupBy("src", "src_null").agg(F.sum("bin_size").alias("source_size")), weights, share, max_epochs)
    whole = F.when(F.col("target") >= F.col("source_size") * F.lit(float(max_epochs)), F.lit(int(max_epochs)).cast("long")).otherwise(F.floor(F.col("target") / F.expr("nullif(source_size, 0)")))
    plan = targets.withColumn("whole", F.coalesce(whole, F.lit(0)))
    plan = plan.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    before = Window.partitionBy("src", "src_null").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("bin_before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
    plan = bins.join(plan, ["src", "src_null"])
    rows = base.join(plan.drop("bin_size"), ["src", "src_null", "bin"])
    within = Window.partitionBy("src", "src_null", "bin").orderBy("h", "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("bin_before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    more = (F.col("whole") < max_epochs) & (F.col("before") + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    rows = rows.withColumn("copies", F.col("whole") + F.when(more, 1).otherwise(0))
    return rows.select("doc_id", *keys, "size", "source_size", F.col("target").cast("double"), (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of docs, each as often as mix_plan says; columns as given.

    Each row is a document of its own, whatever its doc_id. Documents without words take no words of a source and are left out.
    """
    numbered = staged(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "numbered")
    plan = mix_plan(numbered, row="_mix_row", **settings).where("taken > 0").select("_mix_row", F.col("copies").cast("int").alias("_mix_copies"))
    out = numbered.join(plan, "_mix_row")
    return out.select(*[numbered[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies"))).alias("_mix_copy")).drop("_mix_copy")
