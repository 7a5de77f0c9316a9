"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed pseudo-random order, are cut into blocks.
With whole-number weights the schedule repeats after one period in which
source s gets `weight` slots. In a period of P slots the j-th of a source's c
blocks is released at floor((j-1)P/c) and due at ceil(jP/c); earliest deadline
first among the released blocks (ties: source order) meets all deadlines, so
at any time each source is within one block of its share. When sources run
out, the periods that follow have fewer members; the shares are then those of
the remaining sources. Only the different periods are scheduled: at most two
for each source and one more, so this table depends on the sources only.

DataFrame functions only. A source's order is a rank in two levels (rows per
digest bucket, then rows in a bucket), so a source with a third of all rows is
spread over 16 ** `BUCKET_DIGITS` groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Slots in a period by source; sources not named here share the last entry.
TARGETS = {"src0": 5} | {f"src{i}": 1 for i in range(1, 20)}
OTHERS = 1
#: Documents in a block.
BLOCK = 8
#: Hex digits of the digest that name a bucket of a source.
BUCKET_DIGITS = 3


def _lane(source: str, targets: dict[str, int]) -> Column:
    names = sorted(targets)
    known = F.array(*[F.lit(x) for x in names]) if names else F.array().cast("array<string>")
    at = F.array_position(known, F.coalesce(F.col(source).cast("string"), F.lit("")))
    return F.when(at > 0, at - 1).otherwise(F.lit(len(names))).cast("int")


def numbered(rows: DataFrame, lane: str, digest: str, order: list[str]) -> DataFrame:
    """Add `rank` (from 0): the place in the lane by digest bucket, then digest and `order`."""
    rows = rows.withColumn("_bucket", F.substring(digest, 1, BUCKET_DIGITS))
    before = (rows.groupBy(lane, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .select(lane, "_bucket", F.coalesce(F.sum("_n").over(
                  Window.partitionBy(lane).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy(lane, "_bucket").orderBy(digest, *order))
    return (rows.withColumn("_inside", inside).join(before, [lane, "_bucket"])
            .withColumn("rank", F.col("_before") + F.col("_inside") - 1).drop("_bucket", "_inside", "_before"))


def period_kinds(lanes: DataFrame) -> DataFrame:
    """From lanes (lane, weight, blocks): runs of equal periods.

    first (period number), slots_before, size P, members [(lane, c)].
    """
    last = F.floor((F.col("blocks") - 1) / F.col("weight")).alias("last")
    all_lanes = lanes.groupBy().agg(F.sort_array(F.collect_list(
        F.struct("lane", "weight", "blocks", last))).alias("all"))  # one row, an entry for each lane
    firsts = F.array_distinct(F.flatten(F.transform(
        "all", lambda x: F.array(F.lit(0).cast("long"), x["last"], x["last"] + 1))))
    kinds = (all_lanes.select("all", F.explode(firsts).alias("first"))
             .withColumn("members", F.transform(
                 F.filter("all", lambda x: x["last"] >= F.col("first")),
                 lambda x: F.struct(x["lane"].alias("lane"), F.least(
                     x["weight"], x["blocks"] - F.col("first") * x["weight"]).cast("int").alias("c"))))
             .where(F.size("members") > 0)
             .select("first", "members", F.aggregate("members", F.lit(0), lambda n, m: n + m["c"]).alias("size")))
    w = Window.orderBy("first")
    return (kinds.withColumn("until", F.lead("first").over(w))
            .withColumn("slots_before", F.coalesce(
                F.sum((F.col("until") - F.col("first")) * F.col("size")).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0))))


def earliest_deadline_first() -> Column:
    """The lane index in each slot of a period (columns size and members)."""
    def step(state: Column, t: Column) -> Column:
        def offer(m: Column, i: Column) -> Column:
            done = state["done"][i]
            released = F.floor(done * F.col("size") / m["c"]) <= t
            due = F.ceil((done + 1) * F.col("size") / m["c"])
            return F.when((done < m["c"]) & released, F.struct(due.alias("due"), i.alias("i")))

        pick = F.array_min(F.transform(F.col("members"), offer))["i"]
        return F.transform(F.array(pick), lambda p: F.struct(
            F.transform(state["done"], lambda d, i: F.when(i == p, d + 1).otherwise(d)).alias("done"),
            F.concat(state["picks"], F.array(p)).alias("picks"))).getItem(0)

    start = F.struct(F.transform(F.col("members"), lambda m: F.lit(0)).alias("done"),
                     F.array().cast("array<int>").alias("picks"))
    return F.aggregate(F.sequence(F.lit(0), F.col("size") - 1), start, step, lambda s: s["picks"])


def schedule(kinds: DataFrame) -> DataFrame:
    """first, size, slots_before, lane, j (from 1), slot: the periods' templates."""
    slots = kinds.withColumn("picks", earliest_deadline_first()).select(
        "first", "size", "slots_before", "members", F.posexplode("picks").alias("slot", "i"))
    slots = slots.select("first", "size", "slots_before", "slot", F.col("members")[F.col("i")]["lane"].alias("lane"))
    return slots.withColumn("j", F.row_number().over(Window.partitionBy("first", "lane").orderBy("slot")))


def mix(docs: DataFrame, targets: dict[str, int] | None = None, others: int = OTHERS, block: int = BLOCK,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The input's columns and `_lane`, `_block`, `_slot`, `_position` of every row.

    Every row is used exactly once. `_slot` numbers the blocks of the mix from
    0, `_position` the documents (gapless, the mixed order). Null and unlisted
    sources share one lane of weight `others`. A source's last block may be
    short. Rows with equal ids are placed in any order among themselves; a
    null id counts as the text 'null'. Weights are whole numbers over 0. An
    empty table gives no rows. All columns are kept, whatever their names.
    """
    targets = TARGETS if targets is None else targets
    if others < 1 or any(w < 1 for w in targets.values()):
        raise ValueError("weights are whole numbers of at least 1")
    digest = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))
    rows = docs.select(F.struct("*").alias("row"), _lane(f"`{source_col}`", targets).alias("lane"),
                       digest.alias("digest"))
    rows = written(numbered(rows, "lane", "digest", []).drop("digest"), "mix-rows")
    weights = F.array(*[F.lit(targets[x]) for x in sorted(targets)], F.lit(others))
    lanes = written(rows.groupBy("lane").agg(F.count(F.lit(1)).alias("docs"))
                    .select("lane", "docs", weights[F.col("lane")].alias("weight"),
                            F.ceil(F.col("docs") / block).alias("blocks")), "mix-lanes")
    plan = written(schedule(period_kinds(lanes)), "mix-plan")
    # both lists have an entry or two for each lane
    firsts = sorted(r[0] for r in plan.select("first").distinct().collect())
    first_of = F.element_at(F.filter(F.array(*[F.lit(x).cast("long") for x in firsts or [0]]),
                                     lambda x: x <= F.col("period")), -1)
    p = F.broadcast(plan.select(F.col("first").alias("pf"), F.col("lane").alias("pl"), F.col("j").alias("pj"),
                                "size", "slots_before", F.col("slot").alias("in_period")))

    def slotted(blocks: DataFrame) -> DataFrame:
        return (blocks.withColumn("period", F.floor(F.col("b") / F.col("weight")))
                .withColumn("k", (F.col("b") % F.col("weight") + 1).cast("int")).withColumn("f", first_of)
                .join(p, (F.col("f") == F.col("pf")) & (F.col("lane") == F.col("pl")) & (F.col("k") == F.col("pj")))
                .withColumn("slot", F.col("slots_before") + (F.col("period") - F.col("f")) * F.col("size")
                            + F.col("in_period")))

    placed = slotted(rows.withColumn("b", F.floor(F.col("rank") / block))
                     .withColumn("weight", weights[F.col("lane")]))
    # documents before a slot: whole blocks, less what short last blocks lack in earlier slots
    lack = F.col("blocks") * block - F.col("docs")
    shorts = slotted(lanes.withColumn("b", F.col("blocks") - 1)).select("slot", lack.alias("lack")).where("lack > 0")
    listed = [F.struct(F.lit(r["slot"]).cast("long").alias("slot"), F.lit(r["lack"]).cast("long").alias("lack"))
              for r in shorts.collect()]
    short = F.array(*listed) if listed else F.array().cast("array<struct<slot:long,lack:long>>")
    lacking = F.aggregate(F.filter(short, lambda s: s["slot"] < F.col("slot")), F.lit(0).cast("long"),
                          lambda acc, s: acc + s["lack"])
    return (placed.select("row.*", F.col("lane").alias("_lane"), F.col("b").alias("_block"), F.col("slot").alias("_slot"),
                          (F.col("slot") * block - lacking + F.col("rank") % block).alias("_position")))
