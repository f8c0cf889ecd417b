"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: sources, by code point and null last, take `weights` in turn and share `share` of all words; a target stops at `most` times its
source's words, and what is above is dealt anew by weight until no target is above.

Draw: the documents of a source stand in a permuted order, by the MD5 of the seed, their id and text. The order is passed as
often as the target asks, the last pass up to the document whose middle lies before the target's end, so a source's taken words miss its
target by half a document at most. Every pass is a row of blocks of `block_words` words; a document belongs to the block that
its first word is in. The blocks of all passes are the source's quota, and the quotas are dealt to the output shards by a tree:
a node holds the quotas of a run of shards and gives its left half a multivariate-hypergeometric draw (each source in turn a
hypergeometric draw from what is left), so the sums of sources and shards are exact. Blocks of a source are numbered in a permuted
way, and each shard has its own range of these numbers, so no block is in two shards. Within a shard the documents are shuffled by a hash.

All of it is native expressions. A hypergeometric draw inverts the distribution over 12 standard deviations about its mean, more than a
double can tell apart. Random numbers are hashes of the seed and the place in the tree, so reruns agree.

Memory and shuffles: texts are read once, for sizes and digests; after that a document is a narrow row. Running sums of a source are made in
buckets of about `bucket_rows` documents, then over buckets, so a source with a third of all rows is many tasks. A node's
quotas are one array with a number for each source: sources are a list that people give weights to, and a list of millions would
make long rows. The source table is broadcast only up to 10,000 sources.

Nulls: a null text has 0 words, a null source is a source. Sources without words have a target of 0. Rows alike in id and text are rows
of their own, in any order. Other columns are ignored, so that clashing names do no harm; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared
from .quality import let

WEIGHTS, SHARE, MOST = (3, 1, 2), (3, 2), 2
BLOCK_WORDS, SHARD_WORDS, BUCKET_ROWS, SEED = 1 << 13, 1 << 24, 1 << 15, "mix"
_BROADCAST, _DEALT = 10_000, 8  # sources; levels after which nodes are dealt to tasks


def _key(seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(shared.whole_text())))


def sized(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, key of every document; keys are hexadecimal and put them in the permuted order."""
    size = F.regexp_count(shared.whole_text(), F.lit("[^ \\t-\\r]+")).cast("long")
    return documents.select("doc_id", "source", size.alias("size"), _key(seed).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """source, rank, n_docs, source_size, target: one row for each source of the table (source, size). share is a fraction."""
    own = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    own = own.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    own = own.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1).cast("long"))
    up, down = share
    total = own.agg(F.sum("source_size")).first()[0] or 0
    full, target = F.lit(False), F.lit(0.0)
    bound = most * F.col("source_size")
    seen = None
    while True:  # each round bounds more sources, and the last one none
        at, free = own.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not free or (at, free) == seen:
            break
        seen = (at, free)
        target = F.col("weight") * F.lit(float(up * total - down * most * at)) / F.lit(float(down * free))
        full = target > bound
    return own.select("source", "rank", "n_docs", "source_size", F.when(full, bound.cast("double")).otherwise(target).alias("target"))


def passes(of_sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds to targets(): whole passes, words of the last pass, blocks of a pass, and the quota of blocks in all passes."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    found = of_sources.withColumn("whole", whole).withColumn("last", F.col("target") - F.col("whole") * F.col("source_size"))
    found = found.withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)))
    return found.withColumn("quota", F.col("whole") * F.col("blocks") + F.least("blocks", F.ceil(F.col("last") / block_words)))


def _hypergeometric(u: Column, q: Column, rest: Column, n: Column) -> Column:
    """How many of n blocks drawn from q + rest are of the q, by the inverse of the distribution at u."""
    all_ = q + rest
    mean = n * q / F.greatest(all_, F.lit(1))
    spread = 12 * F.sqrt(mean * (1 - q / F.greatest(all_, F.lit(1))) * (all_ - n) / F.greatest(all_ - 1, F.lit(1))) + 12
    ends = F.struct(
        F.greatest(F.lit(0), n - rest, F.floor(mean - spread)).cast("long").alias("a"),
        F.least(q, n, F.ceil(mean + spread)).cast("long").alias("b"),
    )

    def found(x: Column) -> Column:
        steps = F.sequence(x["a"], x["b"])
        ratio = lambda k: (q - k).cast("double") * (n - k) / ((k + 1).cast("double") * (rest - n + k + 1))
        start = F.lit(1e-250)  # weights up to the mode grow
        total = F.aggregate(steps, F.struct(start.alias("w"), F.lit(0.0).alias("t")), lambda s, k: F.struct((s["w"] * ratio(k)).alias("w"), (s["t"] + s["w"]).alias("t")), lambda s: s["t"])

        def below(total: Column) -> Column:
            step = lambda s, k: F.struct((s["w"] * ratio(k)).alias("w"), (s["t"] + s["w"]).alias("t"), (s["k"] + F.when(s["t"] + s["w"] <= u * total, 1).otherwise(0)).alias("k"))
            return F.aggregate(steps, F.struct(start.alias("w"), F.lit(0.0).alias("t"), x["a"].alias("k")), step, lambda s: F.least(s["k"], x["b"]))

        return let(total, below)

    return let(ends, found)


def _halves(seed: str) -> Column:
    """The two nodes that a node (start, shards, quotas) makes; a node of one shard stays."""
    start, shards, quotas = F.col("start"), F.col("shards"), F.col("quotas")
    left = F.floor(shards / 2).cast("long")
    all_ = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x["q"])

    def dealt(n: Column) -> Column:
        begin = F.struct(n["all"].alias("rest"), n["left"].alias("n"), F.array().cast("array<long>").alias("taken"))

        def step(a: Column, x: Column) -> Column:
            u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), start, shards, x["rank"]), 11) / F.lit(float(1 << 53))
            return let(_hypergeometric(u, x["q"], a["rest"] - x["q"], a["n"]), lambda k: F.struct((a["rest"] - x["q"]).alias("rest"), (a["n"] - k).alias("n"), F.concat(a["taken"], F.array(k)).alias("taken")))

        def nodes(taken: Column) -> Column:
            part = lambda count: F.filter(F.zip_with(quotas, taken, lambda x, k: F.struct(x["rank"].alias("rank"), count(x["q"], k).alias("q"))), lambda x: x["q"] > 0)
            node = lambda s, n, q: F.struct(s.alias("start"), n.alias("shards"), q.alias("quotas"))
            return F.array(node(start, left, part(lambda q, k: k)), node(start + left, shards - left, part(lambda q, k: q - k)))

        return let(F.aggregate(quotas, begin, step, lambda a: a["taken"]), nodes)

    split = let(F.struct(all_.alias("all"), F.floor(all_ * left / shards).cast("long").alias("left")), dealt)
    return F.when(shards > 1, split).otherwise(F.array(F.struct(start.alias("start"), shards.alias("shards"), quotas.alias("quotas"))))


def tree(quotas: DataFrame, n_shards: int, seed: str = SEED) -> DataFrame:
    """shard, rank, q: the quotas of the table (rank, quota) dealt to the shards; rows without blocks are left out."""
    entry = F.struct(F.col("rank").cast("long").alias("rank"), F.col("quota").cast("long").alias("q"))
    nodes = quotas.filter("quota > 0").agg(F.array_sort(F.collect_list(entry)).alias("quotas"))
    nodes = nodes.select(F.lit(0).cast("long").alias("start"), F.lit(n_shards).cast("long").alias("shards"), "quotas")
    for level in range((n_shards - 1).bit_length()):
        nodes = nodes.select(F.explode(_halves(seed)).alias("x")).select("x.*")
        if level % _DEALT == _DEALT - 1:
            nodes = nodes.repartition("start")
    return nodes.select(F.col("start").alias("shard"), F.explode("quotas").alias("x")).select("shard", "x.rank", "x.q")


def mix(
    spark: SparkSession,
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    bucket_rows: int = BUCKET_ROWS,
    seed: str = SEED,
) -> DataFrame:
    """A row for each time that the mix takes a document: shard, position there, pass, and the document's doc_id, key, source, size, source_size, target;
    documents that aren't taken have one row without shard, position and pass. (rank, bucket, place) names the row of documents."""
    scratch = shared.Scratch(spark, "mixing")
    docs = scratch.save(sized(documents, seed), "sized")
    sources = scratch.save(passes(targets(docs, weights, share, most), block_words), "sources")
    n_sources, blocks = sources.agg(F.count("*"), F.sum("quota")).first()
    n_shards = max(1, -(-(blocks or 0) * block_words // shard_words))
    small = F.broadcast if n_sources <= _BROADCAST else lambda x: x
    # places in the permuted order
    docs = docs.join(small(sources), docs["source"].eqNullSafe(sources["source"])).drop(docs["source"])
    buckets = F.ceil(F.col("n_docs") / bucket_rows)
    at = F.conv(F.substring("key", 1, 15), 16, 10).cast("double") / F.lit(float(1 << 60))
    docs = docs.withColumn("bucket", F.least(F.floor(at * buckets), buckets - 1).cast("long"))
    order = Window.partitionBy("rank", "bucket").orderBy("key")
    docs = docs.withColumn("place", F.row_number().over(order)).withColumn("before", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    docs = scratch.save(docs, "placed")
    sums = docs.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    docs = docs.join(sums, ["rank", "bucket"]).withColumn("start", F.col("earlier") + F.col("before")).drop("earlier", "before")
    # times that each is taken, and the block of each time
    times = F.col("whole") + F.when(F.col("start") + F.col("size") / 2 < F.col("last"), 1).otherwise(0)
    docs = docs.withColumn("pass", F.explode_outer(F.when((F.col("size") > 0) & (times > 0), F.sequence(F.lit(0).cast("long"), times - 1))))
    block = F.least(F.floor(F.col("start") / block_words), F.col("blocks") - 1)
    numbered = lambda i: F.pmod(i * F.lit(1_000_000_007) + F.pmod(F.xxhash64(F.lit(seed), "rank"), F.lit(1_000_000_007)), F.col("quota"))
    docs = docs.withColumn("number", numbered(F.col("pass") * F.col("blocks") + block))
    # each shard has a range of a source's numbers
    leaves = scratch.save(tree(sources, n_shards, seed), "leaves")
    ends = F.sum("q").over(Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    drawn = leaves.withColumn("end", ends).select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("q"), F.col("end") - 1)).alias("number"))
    placed = docs.join(drawn, ["rank", "number"], "left")
    apart = F.when(F.col("shard").isNull(), F.struct("rank", "bucket"))
    shuffled = Window.partitionBy("shard", apart).orderBy(F.xxhash64(F.lit(seed), "key", "pass"), "key", "pass")
    placed = placed.withColumn("position", F.when(F.col("shard").isNotNull(), F.row_number().over(shuffled) - 1))
    found = scratch.save(placed.select("rank", "bucket", "place", "doc_id", "key", "source", "size", "source_size", "target", "pass", "shard", "position"), "mix")
    scratch.keep("mix")
    return found


def taken(mixed: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    words = F.sum(F.when(F.col("shard").isNotNull(), F.col("size")).otherwise(0))
    same = ["doc_id", "source", "size", "source_size", "target"]
    rows = mixed.groupBy("rank", "bucket", "place").agg(*[F.first(c).alias(c) for c in same], words.alias("taken"))
    return rows.select(*same, "taken")


def write(documents: DataFrame, mixed: DataFrame, path: str, seed: str = SEED) -> None:
    """Writes doc_id, text in the order of their positions, one folder for each shard."""
    texts = documents.select(_key(seed).alias("key"), shared.whole_text().alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    rows = mixed.filter(F.col("shard").isNotNull()).select("key", "doc_id", "shard", "position").join(texts, "key")
    rows.select("shard", "position", "doc_id", "text").repartition("shard").sortWithinPartitions("shard", "position").write.mode("overwrite").partitionBy("shard").parquet(path)
