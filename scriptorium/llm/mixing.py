"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

A source's target is its weight's share of a volume (150 % of all words); what would be over twice the source's words is shared again among the others by weight, until none is over. The volume is counted in
blocks of equally many words. Sources get whole numbers of blocks by the highest quotients target / (2k + 1), but for those at twice their words, which give every block twice. Each source's documents are dealt into shards by a
seeded hash, and the source's blocks go to its shards in the same way, by the highest quotients of the shards' numbers of blocks. In a shard documents stand in order of the seeded hash, their words in a row are cut into blocks, and a
shard of m blocks with a quota of q takes block k floor((k + 1) * q + r) / m) - floor((k * q + r) / m) times, r seeded: q times in all, evenly spread, none over twice. So what a document gives follows
from its place by arithmetic: no row a block.

The highest quotients are found without a list of all: a divisor that surely gives too few seats and one that surely gives too many bound each row's last seats, about five candidates a row in all, of which the
highest are taken by their place in the order. Places come from counts of ranges, so neither sources nor a source's shards meet in one task, and a source with most rows is dealt by its shards like any other. Texts aren't moved:
ids, sizes and hashes are.

Defined results: a null text has size 0; what has size 0 gives nothing. Sources are in order of code points, null last, each null source row of one source "null"; '' is a source. Equal quotients (ties) go to the source or shard that comes first. Rows
that are equal in id and text have places next to each other, so they may give different parts; repeated ids with other texts are documents of their own, and a null id is like any other. A very long text is cut into blocks like any other and may reach over
all of a shard. A quota is never over twice a shard's blocks; where quotients would give more, the seat is left empty (one or two blocks of a source). A source smaller than half a block may give nothing. The number of rounds in which targets settle
is at most the number of sources. No rows: no rows. Columns other than the id, the text and the source are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.storage import materialize, reading, tables

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, PERCENT, COPIES = (3, 1, 2), 150, 2
#: Words of a block; words and documents of a shard, about.
BLOCK, SHARD_WORDS, SHARD_DOCS = 16, 1 << 13, 1 << 10
SEED = "mix"

Keep = Callable[[DataFrame, str], DataFrame]


def number(digest: Column) -> Column:
    """The first eight hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def placed(df: DataFrame, group: list[str], order: list[Column], keep: Keep, tag: str) -> DataFrame:
    """df with place, from 0, within its group (columns without null) in that order. No task takes a whole group: rows are counted by range and group, and a row's place is what the ranges before hold and its own place in its range."""
    dealt = keep(df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("__part", F.spark_partition_id()), tag)
    counts = dealt.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    # a group is in neighbouring ranges: a row for each group, and one more for each range at most
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy(*group).orderBy("__part")) - F.col("__n")).drop("__n")
    own = F.row_number().over(Window.partitionBy(*group, "__part").orderBy(*order)) - 1
    return dealt.join(before, [*group, "__part"]).withColumn("place", own + F.col("__before")).drop("__part", "__before")


def apportioned(df: DataFrame, group: str, key: str, votes: str, seats: str, keep: Keep, tag: str) -> DataFrame:
    """df with quota: the group's seats (a column, alike in a group) among its rows by the highest quotients votes / (2k + 1); of equal ones the smallest key first. Rows without votes get none."""
    sums = df.where(F.col(votes) > 0).groupBy(F.col(group).alias("__g")).agg(F.sum(votes).cast("double").alias("__v"), F.count("*").alias("__n"))
    # a row gets votes / divisor rounded, so the divisors that give all seats lie between these two; one more or less is for the rounding of numbers
    seat, half = F.col(seats), F.col("__n") / 2
    few, many = F.when(seat > half, F.floor(F.col(votes) / F.col("__v") * (seat - half) + 0.5) - 1).otherwise(0), F.floor(F.col(votes) / F.col("__v") * (seat + half) + 0.5) + 1
    bounds = keep(df.join(sums, F.col(group) == F.col("__g"), "left").withColumn("__few", F.when(F.col(votes) > 0, F.greatest(F.lit(0), few)).otherwise(0)).withColumn("__many", F.when(F.col(votes) > 0, many).otherwise(0)).drop("__g", "__v", "__n"), f"{tag}-bounds")
    left = bounds.groupBy(F.col(group).alias("__g")).agg((F.max(seats) - F.sum("__few")).alias("__left"))
    more = bounds.where(F.col("__many") > F.col("__few")).select(group, key, F.explode(F.sequence("__few", F.col("__many") - 1)).alias("__k"), votes).withColumn("__q", F.col(votes) / (2 * F.col("__k") + 1))
    ranked = placed(more, [group], [F.desc("__q"), F.col(key), F.col("__k")], keep, f"{tag}-places")
    won = ranked.join(left, F.col(group) == F.col("__g")).where(F.col("place") < F.col("__left")).groupBy(group, key).agg(F.count("*").alias("__won"))
    return bounds.join(won, [group, key], "left").withColumn("quota", F.col("__few") + F.coalesce("__won", F.lit(0))).drop("__few", "__many", "__won")


def targets(sources: DataFrame, percent: int = PERCENT, copies: int = COPIES) -> DataFrame:
    """sources (source_size, weight) with target and full, which says that the target is copies times the source's words."""
    most = F.col("source_size") * copies
    target, known = None, -1
    while True:
        full = F.lit(False) if target is None else target > most
        all_words, given, weights, n = sources.agg(F.sum("source_size"), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if n == known or not weights:
            return sources.withColumn("full", full).withColumn("target", F.when(full, most.cast("double")).otherwise(target if target is not None else F.lit(0.0)))
        known, target = n, F.col("weight") * F.lit(float(percent * all_words / 100 - (given or 0))) / F.lit(float(weights))


def _sources(sizes: DataFrame, keep: Keep, weights: tuple[int, ...], percent: int, copies: int, block: int) -> DataFrame:
    """rank, name, none (is it null), source_size, target, full, n_shards, quota of every source."""
    found = sizes.groupBy("none", "name").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n")).withColumn("all", F.lit(0))
    ranked = placed(found, ["all"], [F.col("none"), F.col("name")], keep, "mixing-sources").withColumnRenamed("place", "rank")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int"))
    told = keep(targets(keep(ranked.withColumn("weight", weight), "mixing-ranked"), percent, copies), "mixing-targets")
    # a row: what isn't full shares what the full ones leave
    open_words = told.agg(F.coalesce(F.sum(F.when(~F.col("full"), F.col("target"))), F.lit(0.0)).alias("t")).first()["t"]
    dealt = told.withColumn("votes", F.when(~F.col("full"), F.col("target")).otherwise(0.0)).withColumn("seats", F.lit(int(open_words / block + 0.5)))
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / SHARD_WORDS), F.ceil(F.col("n") / SHARD_DOCS))
    return apportioned(dealt, "all", "rank", "votes", "seats", keep, "mixing-seats").select("rank", "name", "none", "source_size", "target", "full", shards.alias("n_shards"), "quota")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, copies: int = COPIES, block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, spans (array<struct<first, n, times>>: which words of the document, from 0, and how often), key (of the row)."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    with tables() as keep:
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
        sizes = keep(docs.select("doc_id", "source", size.alias("size"), key.alias("key"), F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none")), "mixing-sizes")
        sources = keep(_sources(sizes, keep, weights, percent, copies, block), "mixing-quotas")
        shard = F.when(F.col("size") > 0, number(F.col("key")) % F.col("n_shards")).otherwise(-1)
        rows = keep(sizes.join(sources.hint("merge"), ["none", "name"]).withColumn("shard", shard).select("doc_id", "source", "size", "key", "source_size", "target", "rank", "shard", "full", F.col("quota").alias("seats")), "mixing-rows")
        held = rows.where("size > 0").groupBy("rank", "shard").agg(F.ceil(F.sum("size") / block).alias("m"), F.any_value("full").alias("full"), F.any_value("seats").alias("seats"))
        dealt = apportioned(held.withColumn("votes", F.when(~F.col("full"), F.col("m")).otherwise(0)), "rank", "shard", "votes", "seats", keep, "mixing-shards")
        quota = F.when(F.col("full"), F.col("m") * copies).otherwise(F.least("quota", F.col("m") * copies))
        start = number(F.md5(F.concat_ws(":", F.lit(seed), F.col("rank").cast("string"), F.col("shard").cast("string")).cast("binary"))) % F.col("m")
        shards = materialize(dealt.select("rank", "shard", "m", quota.alias("q"), start.alias("r")), "mixing-quotas")
        rows = materialize(rows.drop("full", "seats"), "mixing-placed")
    here = rows.where("size > 0").join(shards, ["rank", "shard"])
    here = here.withColumn("at", F.sum("size").over(Window.partitionBy("rank", "shard").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    upto = lambda k: F.floor((k * F.col("q") + F.col("r")) / F.col("m"))

    def span(k: Column) -> Column:
        first = F.greatest(k * block, F.col("at"))
        return F.struct((first - F.col("at")).alias("first"), (F.least((k + 1) * block, F.col("at") + F.col("size")) - first).alias("n"), (upto(k + 1) - upto(k)).alias("times"))

    blocks = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["n"] * s["times"])
    given = here.withColumn("spans", F.filter(F.transform(blocks, span), lambda s: s["times"] > 0)).withColumn("taken", taken)
    columns = ["doc_id", "source", "size", "source_size", "target", "taken", "spans", "key"]
    nothing = rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn("spans", F.array().cast(given.schema["spans"].dataType))
    return reading(given.select(*columns).unionByName(nothing.select(*columns)), rows, shards)


def pieces(docs: DataFrame, mixed: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, first, piece, times: the words of each span of what mix() gave for docs, as they stand in the text, with the blanks after each."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    # rows of equal id and text share a key: each of their spans is cut out of the same text
    texts = docs.select(key.alias("key"), "text").dropDuplicates(["key"])
    spans = mixed.where(F.size("spans") > 0).select("key", "doc_id", "source", "spans")
    cut = spans.join(texts, "key").withColumn("w", F.regexp_extract_all("text", F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0)))
    return cut.select("doc_id", "source", F.explode("spans").alias("s"), "w").select(
        "doc_id", "source", F.col("s.first").alias("first"), F.array_join(F.slice("w", (F.col("s.first") + 1).cast("int"), F.col("s.n").cast("int")), "").alias("piece"), F.col("s.times").alias("times")
    )
