"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame operations only.

The words of each source are laid on a line, document after document in the order of a hash, and cut into blocks
of equal length. A source's quota is a whole number of blocks. A binary tree deals the quotas out to the shards:
each node gives half of its blocks to the left, and how many of them are of which source is drawn as if the blocks
were picked blindly. A source's blocks are permuted once per pass over it, and its shards take consecutive parts of
that list, so no block is drawn twice in a pass and quotas are met exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmill.llm.common import numbered
from riskmill.sources.workspace import stage, stage_only

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCKS = 65_536
SHARD_LEVELS = 6  # 64 shards
ROWS_PER_BUCKET = 20_000
WORD = r"[^\x20\x09-\x0D]++"


def mixing_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with number and target of each source, in the order of code points.

    Targets share the sum of all sizes by weight; none is above ``repeats`` times its source's size, and what is
    left over goes to the others by weight. So a target is min(repeats * size, level * weight), and the level is
    the largest of those at which the sources of the smallest ratios of limit to weight are taken as full. The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("sid", F.row_number().over(by_name))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    limited = numbered.withColumns({"weight": weight, "limit": F.lit(repeats) * F.col("source_size")})
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    full = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    leveled = limited.withColumn("level", (F.sum("source_size").over(everything) - full) / rest)
    target = F.least(F.col("limit").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return leveled.withColumn("target", target).select("sid", "source", "source_size", "target")


def _quotas(targets: DataFrame, blocks: int) -> DataFrame:
    """Blocks of each source, and how many of them are taken, repeats counted."""
    share = F.col("source_size") * F.lit(blocks) / F.sum("source_size").over(Window.partitionBy())
    count = F.least("source_size", F.greatest(F.lit(1), F.ceil(share)))
    cut = targets.filter("source_size > 0").withColumn("blocks", count.cast("bigint"))
    return cut.withColumn("quota", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def _left_half(seed: int, level: int) -> Column:
    """Quotas of the left child of a node.

    Goes through the node's blocks source by source and picks each with the chance (still to pick) / (still to
    come): every choice of half of the blocks is equally likely, so the numbers by source are
    multivariate-hypergeometric.
    """

    def source(state: Column, quota: Column) -> Column:
        def block(inner: Column, number: Column) -> Column:
            chance = _uniform(F.lit(seed), F.lit(level), F.col("node"), quota["sid"], number)
            picked = F.when(chance * inner["rest"] < inner["wanted"], 1).otherwise(0).cast("bigint")
            return F.struct(
                (inner["rest"] - 1).alias("rest"),
                (inner["wanted"] - picked).alias("wanted"),
                (inner["got"] + picked).alias("got"),
            )

        start = F.struct(state["rest"].alias("rest"), state["wanted"].alias("wanted"), F.lit(0).cast("bigint").alias("got"))
        numbers = F.when(quota["n"] > 0, F.sequence(F.lit(1).cast("bigint"), quota["n"])).otherwise(
            F.expr("CAST(array() AS array<bigint>)")
        )
        after = F.aggregate(numbers, start, block)
        mine = F.struct(quota["sid"].alias("sid"), after["got"].alias("n"))
        return F.struct(
            after["rest"].alias("rest"), after["wanted"].alias("wanted"), F.array_append(state["left"], mine).alias("left")
        )

    total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q["n"])
    start = F.struct(
        total.alias("rest"),
        F.floor(total / 2).alias("wanted"),
        F.expr("CAST(array() AS array<struct<sid: int, n: bigint>>)").alias("left"),
    )
    return F.aggregate("quotas", start, source)["left"]


def split_quotas(quotas: DataFrame, levels: int = SHARD_LEVELS, seed: int = 0) -> DataFrame:
    """shard, sid, n: the quotas (sid, quota) dealt out to 2**levels shards whose numbers of blocks differ by one
    at most per level. The tree has one row per node; its work is blocks x levels, whatever the documents."""
    pairs = F.sort_array(F.collect_list(F.struct("sid", F.col("quota").alias("n"))))
    nodes = quotas.agg(pairs.alias("quotas")).select(F.lit(0).cast("bigint").alias("node"), "quotas")
    for level in range(levels):
        halves = nodes.withColumn("left", _left_half(seed, level))
        right = F.zip_with(
            "quotas", "left", lambda q, x: F.struct(q["sid"].alias("sid"), (q["n"] - x["n"]).alias("n"))
        )
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
        )
        nodes = halves.select(F.explode(both).alias("half")).select("half.node", "half.quotas")
    return nodes.select(F.col("node").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.sid", "q.n")


def draw_blocks(quotas: DataFrame, levels: int = SHARD_LEVELS, seed: int = 0) -> DataFrame:
    """shard, sid, block, place: the blocks each shard takes; a block comes once per pass over its source."""
    dealt = split_quotas(quotas.select("sid", "quota"), levels, seed)
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("n > 0")
    places = dealt.select("shard", "sid", F.explode(F.expr("sequence(first, first + n - 1)")).alias("place"))
    passes = quotas.filter("quota > 0").select(
        "sid", "blocks", "quota", F.explode(F.expr("sequence(0L, (quota - 1) div blocks)")).alias("pass")
    )
    listed = passes.select("sid", "blocks", "pass", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    shuffled = Window.partitionBy("sid", "pass").orderBy(
        F.xxhash64(F.lit(seed), "sid", "pass", "block"), "block"
    )
    place = F.col("pass") * F.col("blocks") + F.row_number().over(shuffled) - 1
    return places.join(listed.select("sid", "block", place.alias("place")), ["sid", "place"])


class Mix:
    """A mix of documents (``doc_id``, ``text``, ``source``).

    NULL and empty texts have size 0 and are never taken; NULL is a source of its own, the last one; a source of
    size 0 has target 0; NULL and repeated doc_ids are allowed, and each row is a document; other columns are
    ignored; an empty table gives no rows. The same rows and seed give the same mix, however they are partitioned.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[int, ...] = WEIGHTS,
        repeats: int = REPEATS,
        blocks: int = BLOCKS,
        levels: int = SHARD_LEVELS,
        seed: int = 0,
        carry: tuple[str, ...] = (),
    ):
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
        order = F.xxhash64(F.lit(seed), "doc_id", "text")
        sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), order.alias("h"), *carry)
        self.carry = carry
        self.sized = stage(sized, "sizes")
        sizes = self.sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        self.targets = stage(mixing_targets(sizes, weights, repeats), "targets")
        self.quotas = _quotas(self.targets, blocks)
        self.draws = stage(draw_blocks(self.quotas, levels, seed), "draws")
        self.buckets = max(16, self.sized.count() // ROWS_PER_BUCKET)

    def _placed(self) -> DataFrame:
        """Each document with its place ``o`` on the line of its source: sums of buckets, then sums inside."""
        named = self.targets.withColumnRenamed("source", "name")
        rows = self.sized.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        rows = rows.withColumn("bucket", F.pmod("h", F.lit(self.buckets)))
        sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start"))
        inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size")
        earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rows = rows.withColumns({"n_in_bucket": F.row_number().over(inside), "earlier": earlier})
        rows = rows.join(starts, ["sid", "bucket"])
        return rows.withColumn("o", F.col("bucket_start") + F.col("earlier")).drop("h", "earlier", "bucket_start")

    def _pieces(self) -> DataFrame:
        """Every document with every part of it that is drawn; one row with NULLs if none is."""
        cut = self.quotas.select("sid", "blocks")
        rows = self._placed().join(cut, "sid", "left")
        spans = "CASE WHEN size > 0 THEN sequence(((o + 1) * blocks - 1) div source_size, ((o + size) * blocks - 1) div source_size) END"
        rows = rows.withColumn("block", F.explode_outer(F.expr(spans)))
        rows = rows.withColumns(
            {
                "begin": F.expr("greatest(o, block * source_size div blocks) - o"),
                "end": F.expr("least(o + size, (block + 1) * source_size div blocks) - o"),
            }
        )
        return rows.join(self.draws, ["sid", "block"], "left")

    def pieces(self) -> DataFrame:
        """shard, order, doc_id, source, first_word, n_words: what the shards hold; sort a shard by ``order``."""
        taken = self._pieces().filter("shard IS NOT NULL AND `end` > `begin`")
        order = F.xxhash64("shard", "sid", "place", "o")
        return taken.select(
            "shard",
            order.alias("order"),
            "doc_id",
            "source",
            F.col("begin").alias("first_word"),
            (F.col("end") - F.col("begin")).alias("n_words"),
        )

    def report(self) -> DataFrame:
        """doc_id, size, source_size, target, taken (words in the mix, repeats counted), one row per document."""
        return self.taken().select("doc_id", "size", "source_size", "target", "taken")

    def taken(self) -> DataFrame:
        """The report with sid, bucket and n_in_bucket, which name a row, and the columns carried along."""
        words = F.when(F.col("shard").isNotNull(), F.col("end") - F.col("begin")).otherwise(0)
        keys = ["sid", "bucket", "n_in_bucket", "doc_id", "size", "source_size", "target", *self.carry]
        return self._pieces().groupBy(*keys).agg(F.sum(words).alias("taken"))


def whole_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as whole documents: each row as often as its words are taken, the fraction rounded up or down by
    a hash of its own place on the line of its source. Documents without words stay once."""
    rows = numbered(docs, "mix-rows")

    def counted() -> DataFrame:
        shares = Mix(rows.select("row.doc_id", "row.text", "row.source", "number"), seed=seed, carry=("number",)).taken()
        times = F.col("taken") / F.col("size")
        chance = _uniform(F.lit(seed), F.lit("copies"), F.col("sid"), F.col("bucket"), F.col("n_in_bucket"))
        copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(times + chance)).cast("int")
        return shares.select("number", copies.alias("copies")).filter("copies > 0")

    taken = stage_only(docs.sparkSession, "mix-copies", counted)
    return rows.join(taken, "number").withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).select("row.*")
