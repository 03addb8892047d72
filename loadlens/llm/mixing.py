"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Sources get target word counts (``targets``). Each source is laid out as one line of its documents in a pseudo-random
order, and the line is repeated until the target is covered: whole passes, then a part of one. The covered stretch is
cut into the source's exact quota of equal blocks. A binary tree over the output shards then splits the quotas: at each
node the blocks are permuted by a hash and the first half of them goes to the left shards, so the blocks per source on
a side follow the multivariate hypergeometric distribution and every block goes to exactly one shard. ``mix`` gives
the pieces of documents that each shard reads, with the key that shuffles them locally.

Documents are cut only where a block ends, and within the same pass the next block goes on with the rest. So the words
taken of a source equal its target, rounded down, and at most one document of a source is taken in part.

Scale: the texts are reduced to word counts in one scan, stored in the shared folder. A source's line is cut into 256 hash buckets, and only
bucket totals are cumulated over a source, so a source with a third of all rows is still spread over 256 windows.
The block table has ``shards * blocks`` rows at any size of the data and is broadcast.

* null text or no word: size 0, nothing is taken; null source: a source of its own, the last one
* ties and repeated rows: rows equal in id, size and source share an order key, and each has its own stretch of the line
* a source without words has target 0; an empty table gives an empty result
* only id, text and source are read, so other columns cannot clash
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadlens.llm.shared import stored

#: The weights of the sources in order, and the most passes over a source.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Output shards (a power of two) and blocks per shard on average.
SHARDS = 16
BLOCKS = 64
SEED = 20

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _div(number: Column, by: Column) -> Column:
    """Whole division of exact decimals, as words times blocks may not fit a long."""
    return F.call_function("div", number, by.cast("decimal(19,0)"))


def targets(sizes: DataFrame) -> DataFrame:
    """From rows (source, size): source, source_size, target; one row per source.

    Water filling: a source gets ``level * weight``, or its cap if that is less. Sources fill up in the order of cap to
    weight, so one ordered pass over the sources finds the level at which all words are shared out. The windows run
    over one row per source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    cap = MOST_PASSES * F.col("source_size")
    filling = W.orderBy(cap / F.col("weight"), "place")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    open_weight = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / open_weight
    full = F.col("level") >= cap / F.col("weight")
    share = F.min(F.when(~full, F.struct("filling", "level"))).over(everyone)["level"]
    return (
        total.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("filling", F.row_number().over(filling))
        .withColumn("share", share)
        .select(
            "source",
            "place",
            "source_size",
            F.least(cap.cast("double"), F.coalesce(F.col("share") * F.col("weight"), cap.cast("double"))).alias("target"),
        )
    )


def lines(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """``sized`` (doc_id, source, size) with ``start``: the words before the document on its source's line."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("source")).cast("binary"))
    keyed = sized.withColumn("key", key).withColumn("bucket", F.substring("key", 1, 2))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset")
    )
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return (
        keyed.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .select("doc_id", "source", "size", (F.col("offset") + F.col("start")).alias("start"))
    )


def blocks(aims: DataFrame, shards: int = SHARDS, per_shard: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """From ``targets``: source, block, begin, end (words on the repeated line), shard; ``shards * per_shard`` rows.

    Each source with words to draw has one block; the others are shared out by the words to draw, in whole numbers, by
    largest remainders, so that the quotas add up exactly. With more such sources than blocks there is a block for each.
    """
    everyone = W.partitionBy()
    free = F.greatest(F.lit(0), shards * per_shard - F.count("*").over(everyone)).cast("decimal(19,0)")
    product = F.col("drawn") * F.col("free")
    floor = _div(product, F.col("all_drawn"))
    place_by_rest = F.row_number().over(W.orderBy((F.col("product") - F.col("floor") * F.col("all_drawn")).desc(), "place"))
    unit = (
        aims.withColumn("drawn", F.floor("target"))
        .where("drawn > 0")
        .withColumns({"all_drawn": F.sum("drawn").over(everyone).cast("decimal(19,0)"), "free": free})
        .withColumn("product", product)
        .withColumn("floor", floor)
        .withColumn("rest", F.col("free").cast("long") - F.sum("floor").over(everyone))
        .withColumn("quota", F.lit(1) + F.col("floor") + F.when(place_by_rest <= F.col("rest"), 1).otherwise(0))
        .select("source", "place", "quota", "drawn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block"))
        .withColumn("shard", F.lit(0))
    )
    width = shards
    while width > 1:
        permuted = F.row_number().over(W.partitionBy("shard").orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.lit(width), "place", "block").cast("binary")), "place", "block"))
        half = F.count("*").over(W.partitionBy("shard")) / 2
        unit = unit.withColumns({"rank": permuted, "half": half}).withColumn(
            "shard", F.col("shard") + F.when(F.col("rank") > F.col("half"), width // 2).otherwise(0)
        )
        width //= 2
    edge = lambda i: _div(F.col("drawn") * i.cast("decimal(19,0)"), F.col("quota"))
    return unit.select("source", "quota", "drawn", "block", edge(F.col("block")).alias("begin"), edge(F.col("block") + 1).alias("end"), "shard")


def mix(documents: DataFrame, shards: int = SHARDS, per_shard: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """Pieces of documents (doc_id, text, source): doc_id, source, size, start, source_size, target, pass, shard, begin, words, key.

    ``start`` tells rows of a document apart, ``begin`` is the first word of the piece in the document. Rows without
    pieces have null there. Sorting a shard by ``key`` shuffles it.
    """
    sized = stored(documents.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")
    aims = stored(targets(sized), "targets")
    listed = stored(blocks(aims, shards, per_shard, seed), "blocks")
    quotas = listed.groupBy("source").agg(F.first("quota").alias("quota"), F.first("drawn").alias("drawn"))
    aims = aims.join(quotas.withColumnRenamed("source", "q"), F.col("source").eqNullSafe(F.col("q")), "left").drop("q")
    table = F.broadcast(listed.select(F.col("source").alias("ls"), F.col("block").alias("lb"), F.col("begin").alias("block_begin"), "end", "shard"))
    placed = lines(sized, seed).join(
        F.broadcast(aims).select(F.col("source").alias("a"), "source_size", "target", "quota", "drawn"), F.col("source").eqNullSafe(F.col("a"))
    )
    turn = F.explode_outer(F.when((F.col("size") > 0) & F.col("quota").isNotNull(), F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))))
    first = F.col("pass") * F.col("source_size") + F.col("start")
    last = F.least(first + F.col("size"), F.col("drawn")) - 1
    of = lambda word: _div((word + 1).cast("decimal(19,0)") * F.col("quota") - 1, F.col("drawn"))
    met = F.explode_outer(F.when(last >= first, F.sequence(of(first), of(last))))
    begin = F.greatest(F.col("first"), F.col("block_begin"))
    cut = F.col("block").isNotNull()
    pieces = (
        placed.withColumn("pass", turn)
        .withColumn("first", first)
        .withColumn("block", met)
        .where("block is not null or pass is null or pass = 0")
        .join(table, F.col("source").eqNullSafe(F.col("ls")) & (F.col("block") == F.col("lb")), "left")
    )
    return pieces.select(
        "doc_id",
        "source",
        "size",
        "start",
        "source_size",
        "target",
        "pass",
        "shard",
        F.when(cut, begin - F.col("first")).alias("begin"),
        F.when(cut, F.least(F.col("first") + F.col("size"), F.col("end")) - begin).otherwise(0).alias("words"),
        F.xxhash64(F.lit(seed + 1), "doc_id", "start", "pass", "block").alias("key"),
    )


def taken(pieces: DataFrame) -> DataFrame:
    """One row per document row: the words that the mix takes of it, and the shards that they go to."""
    listed = F.array_join(F.array_sort(F.collect_set("shard")).cast("array<string>"), ",")  # as many as there are shards
    rows = ["doc_id", "source", "size", "start", "source_size", "target"]
    whole = pieces.where("size > 0").groupBy(*rows).agg(F.sum("words").alias("taken"), listed.alias("shards"))
    empty = pieces.where("size = 0").select(*rows, F.lit(0).cast("long").alias("taken"), F.lit("").alias("shards"))
    return whole.unionByName(empty)


def repeated(documents: DataFrame, shards: int = SHARDS, per_shard: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """``documents``, each row as often as the mix takes it: words taken by size, rounded."""
    times = taken(mix(documents, shards, per_shard, seed)).where("taken > 0")
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")
    rows = documents.select(row, words(F.col("text")).alias("size"))
    same = ["doc_id", "source", "size"]
    # repeated rows: the sums of their stretches, dealt out evenly
    times = times.groupBy(*same).agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    found = rows.join(
        times.select(*(F.col(c).alias(f"t_{c}") for c in times.columns)),
        F.col("row.doc_id").eqNullSafe(F.col("t_doc_id")) & F.col("row.source").eqNullSafe(F.col("t_source")) & (F.col("size") == F.col("t_size")),
    )
    copies = F.round(F.col("t_taken") / (F.col("size") * F.col("t_rows"))).cast("int")
    return found.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("row.*")
