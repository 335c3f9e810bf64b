"""Mixing sources to target weights by a low-discrepancy schedule.

Sources get shares of the whole corpus by weight; a share stops at ``EPOCHS``
times its source, and the excess is shared again by weight (water level).

Schedule. A source with target t needs ceil(t / block) slots. The needs, laid
end to end, are the cumulative weights on a lattice of 2^L points. Slot n of
the schedule takes the base-2 van der Corput point of n, which falls into one
source's stretch (or behind the last: that slot is skipped). So every prefix of
the schedule is close to the weights, and the whole gives each source exactly
its need. Slots are ranked for each source in schedule order.

Blocks. The documents of a source, shuffled by a seeded hash and repeated up to
``EPOCHS`` times, are one line of words, cut into blocks of equal size. Slot
rank r of a source takes its block r; the last block ends at the target. A
document's taken words are its pieces in the joined blocks.

Running totals (slot ranks, places on the line) are two-level: sums over about
sqrt(rows) hash or slot ranges, then inside a range, so a source that holds
most rows is spread over all tasks.

Defined results: a null source is a source of its own, last; null and empty
texts have size 0 and are never taken; repeated rows are rows of their own; a
null doc_id is mixed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import count_words, fresh, numbered, text_hash, thrifty
from stationflow.session import materialize

WEIGHTS = (5, 2, 1)  # by place of the source, repeating
EPOCHS = 3
BLOCK_WORDS = 256
SEED = "mix"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size): whitespace words of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pa.array(count_words(b.column(3)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), size], names=["doc_id", "source", "text_hash", "size"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(thrifty(run), "doc_id bigint, source string, text_hash bigint, size bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(sid, source, source_size, target) of each source, from rows (source, size).

    With caps of ``epochs`` times the source, resharing until none is above
    ends at a water level: sources in order of cap / weight are capped as long
    as the level of the rest is above their ratio. The windows run over one row
    per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("sid"), F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("w", w.cast("bigint"))
    per = per.withColumn("cap", F.col("source_size") * epochs).withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
    order = Window.orderBy("ratio", "sid")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.col("spent")).cast("double") / F.sum("w").over(rest))
    # the first source whose cap is not below the level of the rest ends the capped ones
    per = per.withColumn("water", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "sid", "level"))).over(Window.partitionBy()))
    capped = F.struct("ratio", "sid") < F.struct(F.col("water.ratio"), F.col("water.sid"))
    target = F.when(capped | F.col("water").isNull(), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("water.level"))
    return per.select(F.col("sid").cast("bigint").alias("sid"), "source", "source_size", target.alias("target"))


def running(rows: DataFrame, key: str, part: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over earlier rows of ``key``; ``part`` is coarse in the same order."""
    sums = rows.groupBy(key, part).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("_key"), F.col(part).alias("_part"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(key, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(sums, (F.col(key) == F.col("_key")) & (F.col(part) == F.col("_part")))
    return joined.withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_key", "_part", "_base")


def schedule(needs: DataFrame, total: int) -> DataFrame:
    """(slot, sid, rank) from needs (sid, need): the mix in order, without the skipped slots."""
    spark = needs.sparkSession
    bits = max(1, math.ceil(math.log2(max(2, total))))
    ends = Window.orderBy("sid")  # one row per source
    stretch = needs.filter("need > 0").withColumn("until", F.sum("need").over(ends)).withColumn("since", F.col("until") - F.col("need"))
    # sources meet points in cells of the lattice, so the range join is an equi-join
    cell = max(0, bits - 10)
    cells = stretch.withColumn("cell", F.explode(F.sequence(F.shiftright("since", cell), F.shiftright(F.col("until") - 1, cell))))
    slots = spark.range(1 << bits).select(F.col("id").alias("slot"))
    # the van der Corput point: the slot's binary digits in reverse
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("bigint")
    slots = slots.withColumn("point", point).withColumn("cell", F.shiftright("point", cell))
    dealt = slots.join(cells.select("sid", "since", "until", "cell"), "cell").filter("point >= since AND point < until")
    dealt = dealt.select("slot", "sid", F.shiftright("slot", bits // 2).alias("stretch"), F.lit(1).cast("bigint").alias("one"))
    return running(dealt, "sid", "stretch", [F.col("slot")], "one", "rank").select("slot", "sid", "rank")


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mixed documents and the joined blocks.

    ``sizes``: rows (doc_id, source, text_hash, size), written already. Returns
    rows (doc_id, source, text_hash, size, source_size, target, start, taken),
    ``start`` being the place on the source's line; and pieces (slot, sid,
    block, start, doc_id, text_hash, from_word, to_word, epoch).
    """
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    goal = materialize(
        targets(sizes, weights, epochs)
        .withColumn("stop", F.least(F.round("target").cast("bigint"), F.col("source_size") * epochs))
        .withColumn("need", F.ceil(F.col("stop") / block)), "targets")
    slots = schedule(goal.select("sid", "need"), goal.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0])
    digits = max(1, min(7, math.ceil(math.log2(n + 1) / 8)))  # 16^digits parts, about sqrt(n)
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce("doc_id", "text_hash").cast("string")).cast("binary"))
    shuffled = sizes.withColumn("key", key).withColumn("part", F.substring("key", 1, digits))
    shuffled = shuffled.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "need")
    line = materialize(running(shuffled, "sid", "part", [F.col("key"), F.col("size"), F.col("text_hash")], "size", "start").drop("key", "part"), "mix-line")
    used = (F.col("size") > 0) & (F.col("start") < F.col("stop"))
    turns = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("stop") - F.col("start") - 1) / F.col("source_size"))))
    whole = line.filter(used).withColumn("epoch", turns).withColumn("a", F.col("start") + F.col("epoch") * F.col("source_size"))
    whole = whole.withColumn("b", F.least(F.col("a") + F.col("size"), F.col("stop")))
    cut = whole.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))))
    first, last = F.greatest("a", F.col("block") * block), F.least("b", (F.col("block") + 1) * block)
    pieces = cut.join(slots.withColumnRenamed("rank", "block"), ["sid", "block"]).select(
        "slot", "sid", "block", "start", "doc_id", "text_hash", (first - F.col("a")).alias("from_word"), (last - F.col("a")).alias("to_word"), "epoch")
    took = pieces.groupBy("sid", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    rows = ["doc_id", "source", "text_hash", "size", "source_size", "target", "start"]
    some = line.filter(used).join(took, ["sid", "start"]).select(*rows, "taken")
    none = line.filter(~used).select(*rows, F.lit(0).cast("bigint").alias("taken"))
    return some.unionAll(none), pieces


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source) of every document."""
    sizes = materialize(sized(docs), "mix-sizes")
    return mix(sizes, **options)[0].select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each time a document is taken, in the input's columns.

    The last document on a source's line is cut after the last word the target
    has room for (``n_chars`` follows the cut); documents not taken go.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    taken = mix(sizes, **options)[0].filter("taken > 0")
    rows, keys = numbered(docs, ["source"])  # rows of one id and text in two sources are different documents
    names = [fresh(x, rows.columns) for x in ("_size", "_taken", "_left")]
    named = [F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("text_hash"), F.col("source").isNull(), F.coalesce("source", F.lit(""))]
    taken = taken.select(*[c.alias(k) for c, k in zip(named, keys[:-1], strict=True)], "start", "size", "taken")
    same = Window.partitionBy(*keys[:-1]).orderBy("start")
    taken = taken.withColumn(keys[-1], F.row_number().over(same)).select(*keys, "size", "taken").toDF(*keys, *names[:2])
    size, took, left = (F.col(n) for n in names)
    each = rows.join(taken, keys).withColumn(names[2], F.explode(F.sequence(took, F.lit(1).cast("bigint"), -size)))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, left.cast("int")), "")
    out = {"text": F.when(left < size, cut).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(left < size, F.length(cut)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return each.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
