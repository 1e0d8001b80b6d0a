"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources share all words by weight, none above `MOST` times its own. In each source the documents stand in
hashed order as one stream of words, cut into blocks; the target becomes a whole number of passes over the
stream plus a number of blocks of one more pass, so every quota of blocks is exact. A binary tree hands the
quotas to the output shards: at each node the left half draws its blocks without replacement, source by
source, from hypergeometric laws. A shard then owns consecutive draws of the permuted blocks, disjoint from
those of all other shards, and orders its documents by a hash.

Only DataFrame functions are used. Random numbers are hashes of the seed, so reruns agree. Word offsets are
running sums in two steps, over hash buckets of about `BUCKET_ROWS` documents and inside them, so no task
holds a source. Identical rows are counted before they are placed, and numbered within their place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import field, settled, table, written_result
from stratiform.workspace import stage

MOST = 3
N_SHARDS = 64
LEAST_BLOCKS = 1024
MOST_BLOCK_WORDS = 65_536
BUCKET_ROWS = 4096
COPIES_PER_TASK = 10_000
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
DERIVED = ["size", "source_size", "target", "taken", "mix"]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """`sizes` (source, source_size, rows) with idx, weight and target.

    Weights 1, 2, 3 repeat over the sources by code point, null last. Filling all sources by weight until
    some are full, and the rest again, ends at one level: target = min(most * size, level * weight).
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("ratio", "idx")
    everything = Window.partitionBy(F.lit(1))
    one = (
        sizes.withColumn("idx", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.col("idx") % 3 + 1)
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    full = F.coalesce(F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("total") - full) / open_weight
    return (
        one.withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "idx", "level"))).over(everything)["level"])
        .withColumn("target", F.coalesce(F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")), F.col("limit").cast("double")))
        .drop("limit", "ratio", "total", "level")
    )


def with_blocks(sources: DataFrame) -> DataFrame:
    """Block size, number of blocks, whole passes and blocks of the last pass of each source."""
    size = F.col("source_size")
    return (
        sources.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCK_WORDS), F.ceil(size / LEAST_BLOCKS))).cast("long"))
        .withColumn("blocks", F.ceil(size / F.col("block")).cast("long"))
        .withColumn("passes", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
        .withColumn("rest", F.least(F.col("blocks"), F.round((F.col("target") - F.col("passes") * size) / F.col("block")).cast("long")))
        .withColumn("rest", F.greatest(F.lit(0), F.col("rest")).cast("long"))
        .withColumn("draws", F.col("passes") * F.col("blocks") + F.col("rest"))
    )


def hypergeometric(marked: Column, drawn: Column, total: Column, u: Column) -> Column:
    """How many of `drawn` items out of `total` are among the `marked` ones, by inversion at `u`.

    Probabilities are followed by their ratios from eight standard deviations below the mode to eight above;
    what lies beyond is less than the precision of a double.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    high = F.least(drawn, marked)
    mode = F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0))
    spread = F.sqrt(
        drawn.cast("double") * marked / F.greatest(total, F.lit(1)) * (total - marked) / F.greatest(total, F.lit(1)) * (total - drawn)
        / F.greatest(total - 1, F.lit(1))
    )
    reach = F.ceil(8 * spread) + 20
    start = F.greatest(low, mode - reach).cast("long")
    stop = F.least(high, mode + reach).cast("long")
    steps = F.when(stop > start, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))

    def following(weight: Column, k: Column) -> Column:
        return weight * (marked - k) * (drawn - k) / ((k + 1.0) * (total - marked - drawn + k + 1))

    whole = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("weight"), F.lit(1.0).alias("sum")),
        lambda s, k: F.struct(following(s["weight"], k).alias("weight"), (s["sum"] + following(s["weight"], k)).alias("sum")),
        lambda s: s["sum"],
    )
    first = F.struct(F.lit(1.0).alias("weight"), F.lit(1.0).alias("sum"), start.alias("at"), (u * whole).alias("goal"))
    return F.aggregate(
        steps,
        first,
        lambda s, k: F.struct(
            following(s["weight"], k).alias("weight"),
            (s["sum"] + following(s["weight"], k)).alias("sum"),
            (s["at"] + F.when(s["sum"] <= s["goal"], 1).otherwise(0)).cast("long").alias("at"),
            s["goal"].alias("goal"),
        ),
        lambda s: s["at"],
    )


def drawn_in_turn(counts: str, quota: Column, *seeds: Column) -> Column:
    """How many of `quota` items each class gets, classes of the sizes in array `counts` being drawn from without replacement.

    One class after the other gets a hypergeometric share of what is left; the running sums are carried along.
    """
    first = F.struct(
        F.array().cast("array<bigint>").alias("out"),
        quota.cast("long").alias("quota"),
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
    )

    def following(s: Column, i: Column) -> Column:
        own = F.get(F.col(counts), i)
        share = hypergeometric(own, s["quota"], s["total"], uniform(*seeds, i))
        return F.transform(
            F.array(share),
            lambda k: F.struct(
                F.concat(s["out"], F.array(k)).alias("out"), (s["quota"] - k).alias("quota"), (s["total"] - own).alias("total")
            ),
        )[0]

    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), first, following, lambda s: s["out"])


def shard_quotas(sources: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """idx and `upto`: how many draws of the source the shards 0 to i take together.

    The tree starts from the draws of all sources. Halves of shards get draws in proportion. A node's sources
    stand in stretches of about the square root of their number, a row each: the node's quota is first drawn for
    the stretches, then within each, so no row holds all sources.
    """
    wide = max(1, math.isqrt(sources.count()))
    numbers = F.transform(F.array_sort(F.collect_list(F.struct("idx", "draws"))), lambda x: x["draws"])
    nodes = sources.groupBy(F.floor(F.col("idx") / wide).cast("int").alias("stretch")).agg(numbers.alias("counts"))
    nodes = stage(nodes.select(F.lit(0).alias("shard"), F.lit(n_shards).alias("width"), "stretch", "counts"), "mix_nodes")
    width = n_shards
    while width > 1:
        sums = nodes.select("shard", "width", "stretch", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("sum"))
        ordered = F.array_sort(F.collect_list(F.struct("stretch", "sum")))
        whole = sums.groupBy("shard", "width").agg(ordered.alias("of"))
        whole = whole.select("shard", "width", F.transform("of", lambda x: x["stretch"]).alias("stretches"), F.transform("of", lambda x: x["sum"]).alias("sums"))
        total = F.aggregate("sums", F.lit(0).cast("long"), lambda a, x: a + x)
        whole = whole.withColumn("quota", F.floor(total * F.floor((F.col("width") + 1) / 2) / F.col("width")).cast("long"))
        shares = settled(whole, "shares", drawn_in_turn("sums", F.col("quota"), F.lit(seed), F.lit(1), F.col("shard"), F.col("width")))
        shares = shares.select("shard", "width", F.inline(F.arrays_zip("stretches", "shares"))).toDF("shard", "width", "stretch", "quota")
        share = nodes.join(shares, ["shard", "width", "stretch"]).withColumn("half", F.floor((F.col("width") + 1) / 2).cast("int"))
        left = drawn_in_turn("counts", F.col("quota"), F.lit(seed), F.lit(2), F.col("shard"), F.col("width"), F.col("stretch"))
        split = settled(share, "left", F.when(F.col("width") > 1, left).otherwise(F.col("counts")))
        right = F.zip_with("counts", "left", lambda a, b: a - b)
        halves = F.array(
            F.struct(F.col("shard"), F.least("half", "width").alias("width"), F.col("left").alias("counts")),
            F.struct((F.col("shard") + F.col("half")).alias("shard"), (F.col("width") - F.col("half")).alias("width"), right.alias("counts")),
        )
        nodes = stage(split.select("stretch", F.explode(halves).alias("n")).select("stretch", "n.*").where("width > 0"), "mix_nodes")
        width = (width + 1) // 2
    order = Window.partitionBy("idx").orderBy("shard")
    quotas = nodes.select("shard", "stretch", F.posexplode("counts").alias("place", "quota"))
    return (
        quotas.select("shard", (F.col("stretch") * wide + F.col("place")).alias("idx"), "quota")
        .withColumn("upto", F.sum("quota").over(order))
        .groupBy("idx")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "upto"))), lambda x: x["upto"]).alias("upto"))
    )


def each_copy(found: DataFrame) -> DataFrame:
    """`found` with `nth`, the number of a row among identical ones (equal marks and `size`), from 0.

    Identical rows are made again from one of them, so that no task numbers them and nothing depends on where
    they were read. A row with very many copies becomes several stretches of copies first, dealt to different tasks.
    """
    alone = found.where("copies IS NULL OR copies = 1").withColumn("nth", F.lit(0).cast("long"))
    same = ["mark", "mark2", "size"]
    others = [c for c in found.columns if c not in same]
    many = found.where("copies > 1").groupBy(*same).agg(*[F.first(c).alias(c) for c in others])
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_TASK).cast("long")))
    dealt = many.withColumn("begin", begin).repartition("mark", "begin")
    upto = F.least(F.col("copies"), F.col("begin") + COPIES_PER_TASK) - 1
    made = dealt.withColumn("nth", F.explode(F.sequence(F.col("begin"), upto))).drop("begin")
    return alone.unionByName(made)


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    n_shards: int = N_SHARDS,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns `keep` (default: all) with size, source_size, target, taken and mix.

    `size` is the number of words. `mix` lists what the mix takes of the document, one entry for each pass
    over its source: pass, words (the first so many; all but at most one document per source and pass are
    whole), shard, and place, a hash that orders the shard. `taken` is the sum of the words. Null is a source
    of its own, an empty string another. Documents without words and sources without words take nothing.
    Identical rows stand next to each other in the stream, each whole in its own place. An empty table gives an
    empty result. Derived columns replace input columns of the same name. `docs` should be a scan: it is read
    several times.
    """
    keep = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*(field(docs, c) for c in keep)).alias("row"),
        field(docs, source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(field(docs, text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(*(field(docs, c) for c in docs.columns)).alias("mark"),
        F.xxhash64(F.lit(1), *(field(docs, c) for c in docs.columns)).alias("mark2"),
    )
    if text not in keep:
        rows = stage(rows, "mix_rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = stage(with_blocks(targets(sizes)), "mix_sources")
    plan = stage(sources.join(shard_quotas(sources, n_shards, seed), "idx", "left"), "mix_plan")

    groups = (
        rows.select("source", "size", "mark", "mark2")
        .where("size > 0")
        .groupBy("source", "size", "mark", "mark2")
        .agg(F.count("*").alias("copies"))
        .withColumn("span", F.col("copies") * F.col("size"))
    )
    known = plan.select(F.col("source").alias("k_source"), F.col("rows").alias("source_rows"))
    order = F.xxhash64(F.lit(seed), F.col("mark"), F.lit("order"))
    spread = groups.join(known, F.col("source").eqNullSafe(F.col("k_source"))).drop("k_source")
    spread = spread.withColumn("order", order).withColumn(
        "bucket", F.floor(uniform(F.col("order")) * F.ceil(F.col("source_rows") / BUCKET_ROWS)).cast("long")
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        spread.groupBy("source", "bucket")
        .agg(F.sum("span").alias("bucket_span"))
        .select(
            F.col("source").alias("b_source"),
            F.col("bucket").alias("b_bucket"),
            F.coalesce(F.sum("bucket_span").over(before), F.lit(0)).alias("bucket_start"),
        )
    )
    inside = Window.partitionBy("source", "bucket").orderBy("order", "mark", "mark2", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        spread.withColumn("until", F.sum("span").over(inside))
        .join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
        .select(F.col("mark").alias("p_mark"), F.col("mark2").alias("p_mark2"), F.col("size").alias("p_size"), "copies", (F.col("bucket_start") + F.col("until") - F.col("span")).alias("start"))
    )
    same = (F.col("mark") == F.col("p_mark")) & (F.col("mark2") == F.col("p_mark2")) & (F.col("size") == F.col("p_size"))
    found = rows.join(placed, same, "left")
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target", "block", "blocks", "passes", "rest", "upto")
    # One row per source: what is broadcast, if anything, is decided by its measured size.
    found = found.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))

    own = F.col("start") + F.col("nth") * F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") * F.col("block") - own))
    placed_rows = each_copy(found).withColumn("at", F.floor(own / F.col("block")).cast("long")).withColumn("last", last.cast("long"))
    passes = F.when(F.col("start").isNull(), F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("passes")))
    draw = lambda p: p * F.col("blocks") + F.least("at", F.when(p < F.col("passes"), F.col("blocks")).otherwise(F.col("rest")) - 1)
    mix = F.filter(
        F.transform(
            passes,
            lambda p: F.struct(
                p.alias("pass"),
                F.when(p < F.col("passes"), F.col("size")).otherwise(F.col("last")).alias("words"),
                F.size(F.filter("upto", lambda c: c <= draw(p))).alias("shard"),
                F.xxhash64(F.lit(seed), F.col("mark"), F.col("nth"), p, F.lit("place")).alias("place"),
            ),
        ),
        lambda m: m["words"] > 0,
    )
    kept = [c for c in keep if c not in DERIVED]
    return (
        placed_rows.withColumn("mix", mix)
        .withColumn("taken", F.aggregate("mix", F.lit(0).cast("long"), lambda a, m: a + m["words"]))
        .select(*(F.col("row").getField(c).alias(c) for c in kept), *DERIVED)
    )


def first_words(text: Column, n: Column) -> Column:
    """The first `n` words of a text with the white space between and behind them."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    return F.array_join(F.slice(pieces, 1, (n + lead).cast("int")), "")


def mixed_copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per taken copy with pass, words, shard and place; a copy that is not whole has its text cut."""
    copies = mixed.select("*", F.explode("mix").alias("copy")).drop("mix")
    body = F.when(F.col("copy")["words"] < F.col("size"), first_words(F.col(text), F.col("copy")["words"])).otherwise(F.col(text))
    return copies.withColumn(text, body).select("*", "copy.*").drop("copy")


def write_mix(mixed: DataFrame, path: str, text: str = "text") -> None:
    """One folder per output shard, its copies in hashed order."""
    copies = mixed_copies(mixed, text)
    copies.repartition("shard").sortWithinPartitions("shard", "place").write.partitionBy("shard").parquet(path)


def op7_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    return written_result(spark, "op7", lambda: mix_sources(docs, keep=["doc_id"]).select(*names))


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, with the columns of the documents; n_chars follows a cut text."""
    copies = mixed_copies(mix_sources(docs))
    cut = F.when(F.col("words") < F.col("size"), F.length("text")).otherwise(F.col("n_chars"))
    return copies.withColumn("n_chars", cut).select(*docs.columns)
