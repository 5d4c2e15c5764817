"""Mixing sources to target weights, by exact quotas of blocks split over output shards.

Every source is cut into blocks by a hash of its documents, and the blocks are put in a pseudo-random order. A source's target
in words becomes whole passes over its blocks plus a last, partial pass; each block of a pass is one draw. A tree halves
the output shards: at each node the draws of every source are divided between the two halves by multivariate
hypergeometric numbers, so every shard gets an exact number of draws and every source keeps its exact quota. A shard then
takes its next draws in the order of the source, disjoint from those of other shards, and orders its documents by a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from requestlens.llm.inputs import WORD
from requestlens.session import store

MOST_REPEATS = 3
BLOCK_ROWS = 512
SHARDS = 16
SEED = 20240521


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``source_no``, ``weight`` and ``target`` to rows of (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, repeating. Targets share the sum of all sizes by weight; none exceeds three
    times its source, and what is cut off is shared again by weight. Taken by ascending ratio of cap to weight,
    the first source whose share stays below its cap fixes the share per weight of all that follow.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", F.col("source_no") % 3 + 1)
    numbered = numbered.withColumn("_cap", F.col("source_size") * MOST_REPEATS).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    order = Window.orderBy("_ratio", "source_no")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = numbered.withColumn(
        "_level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    )
    below = F.col("_level") * F.col("weight") < F.col("_cap")
    level = F.first(F.when(below, F.col("_level")), ignorenulls=True).over(everything)
    return (
        levels.withColumn("_share", level)
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_share") * F.col("weight"), F.col("_cap").cast("double"))))
        .drop("_cap", "_ratio", "_level", "_share")
    )


# One node of the tree: draws of each source that go to the left half. Sources follow one another; each count is hypergeometric given
# the draws and left places that remain, found by inversion over 8 standard deviations around its mean.
_LEFT_COUNTS = """
aggregate(
  counts,
  named_struct('rest', n_all, 'left', n_left, 'out', cast(array() as array<bigint>)),
  (a, c) -> transform(array(
      named_struct('mean', if(a.rest = 0, 0D, c.n * a.left / a.rest),
                   'sd', if(a.rest < 2, 0D, sqrt(c.n * (a.left / a.rest) * (1 - a.left / a.rest) * (a.rest - c.n) / (a.rest - 1))))),
    m -> transform(array(
        named_struct('lo', greatest(0L, a.left - (a.rest - c.n), cast(floor(m.mean - 8 * m.sd) as bigint) - 1),
                     'hi', least(c.n, a.left, cast(ceil(m.mean + 8 * m.sd) as bigint) + 1))),
      s -> transform(array(
          aggregate(sequence(s.lo, s.hi), named_struct('w', 1D, 't', 0D),
            (b, k) -> named_struct('w', b.w * (c.n - k) * (a.left - k) / ((k + 1D) * (a.rest - c.n - a.left + k + 1D)), 't', b.t + b.w)).t
            * (pmod(xxhash64({seed}, node, c.no), 1048576L) + 0.5D) / 1048576D),
        goal -> transform(array(
            aggregate(sequence(s.lo, s.hi), named_struct('w', 1D, 't', 0D, 'x', s.lo),
              (b, k) -> named_struct('w', b.w * (c.n - k) * (a.left - k) / ((k + 1D) * (a.rest - c.n - a.left + k + 1D)), 't', b.t + b.w,
                                     'x', if(b.t < goal, k, b.x))).x),
          x -> named_struct('rest', a.rest - c.n, 'left', a.left - x, 'out', concat(a.out, array(x))))[0])[0])[0])[0],
  a -> a.out)
"""


def split_quotas(quotas: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source_no, shard, draws) from rows of (source_no, draws), by the splitting tree.

    Draws per source stay exact; shards differ by at most one draw per level. Only rows per source and node are held.
    """
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("source_no").alias("no"), F.col("draws").cast("long").alias("n")))).alias("counts")).select(
        F.lit(0).alias("first"), F.lit(n_shards).alias("width"), "counts"
    )
    width = n_shards
    while width > 1:
        left = width // 2
        split = (
            nodes.withColumn("n_all", F.expr("aggregate(counts, 0L, (a, c) -> a + c.n)"))
            .withColumn("n_left", F.expr("(n_all * (width div 2)) div width"))
            .withColumn("node", F.expr("first * 65536L + width"))
            .withColumn("to_left", F.expr(_LEFT_COUNTS.format(seed=seed)))
        )
        nodes = split.selectExpr(
            "inline(array("
            "named_struct('first', first, 'width', width div 2, 'counts', transform(counts, (c, i) -> named_struct('no', c.no, 'n', to_left[i]))), "
            "named_struct('first', first + width div 2, 'width', width - width div 2, 'counts', transform(counts, (c, i) -> named_struct('no', c.no, 'n', c.n - to_left[i])))"
            "))"
        )
        width = max(left, width - left)
        if width > 1:
            nodes = nodes.where("width > 1").unionByName(nodes.where("width = 1")) if n_shards & (n_shards - 1) else nodes
    return nodes.selectExpr("first AS shard", "inline(counts)").select(F.col("no").alias("source_no"), "shard", F.col("n").alias("draws"))


def mix_sources(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, full_copies, part_words, draws.

    Size: words of the text (null: 0). ``taken`` counts the words that the mix takes of a document, repeats counted: whole passes,
    and in the last pass whole documents up to the source's quota, whose last document gives only its first ``part_words``
    words. A source's taken words are its target, rounded. ``draws`` lists for each copy the output shard and the place that
    orders the shard. A null source is a source. The draw depends on ids, sizes, checksums and the seed only, so reruns
    agree; rows that repeat each other may change places. Documents without words take none. An empty table
    gives no rows; other columns are not read. ``n_shards`` is a power of two.
    """
    return _draws(docs, n_shards, seed).drop("_key", "source")


def _draws(docs: DataFrame, n_shards: int, seed: int) -> DataFrame:
    if n_shards < 1 or n_shards & (n_shards - 1):
        raise ValueError("n_shards must be a power of two")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text).alias("_key"),
        ),
        "mixed",
    )
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n")))
    sources = store(
        sources.withColumn("_quota", F.round("target").cast("long"))
        .withColumn("_passes", F.when(F.col("source_size") > 0, F.expr("_quota div source_size")).otherwise(0))
        .withColumn("_rest", F.col("_quota") - F.col("_passes") * F.col("source_size"))
        .withColumn("_blocks", F.ceil(F.col("_n") / BLOCK_ROWS)),
        "sources",
    )
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        rows["doc_id"], rows["source"], rows["size"], rows["_key"], sources["source_no"], sources["source_size"], sources["target"], sources["_passes"], sources["_rest"],
        sources["_blocks"], F.expr("pmod(_key, _blocks)").alias("_block"),
    )
    named = store(named, "blocks")
    blocks = named.groupBy("source_no", "_block").agg(
        F.sum("size").alias("_size"), F.first("_passes").alias("_passes"), F.first("_rest").alias("_rest"), F.first("_blocks").alias("_blocks")
    )
    permuted = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(seed + 1), F.col("source_no"), F.col("_block")), "_block")
    blocks = blocks.withColumn("_rank", F.row_number().over(permuted).cast("long") - 1).withColumn(
        "_block_before", F.sum("_size").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")
    )
    blocks = store(blocks.withColumn("_drawn", F.col("_passes") + F.when((F.col("_block_before") < F.col("_rest")) & (F.col("_size") > 0), 1).otherwise(0)), "draws")
    quotas = split_quotas(blocks.groupBy("source_no").agg(F.sum("_drawn").alias("draws")), n_shards, seed)
    ends = quotas.groupBy("source_no").agg(F.sort_array(F.collect_list(F.struct("shard", "draws"))).alias("_q")).select(
        "source_no", F.expr("transform(_q, (x, i) -> aggregate(slice(_q, 1, i + 1), 0L, (a, y) -> a + y.draws))").alias("_ends")
    )
    # A pass numbers its draws by rank; a draw belongs to the first shard whose last draw lies beyond its number.
    blocks = blocks.join(ends, "source_no").select(
        "source_no", "_block", "_block_before",
        F.expr("transform(if(_drawn > 0, sequence(0L, _drawn - 1), array()), p -> cast(size(filter(_ends, e -> e <= p * _blocks + _rank)) as int))").alias("_shards"),
    )
    in_block = Window.partitionBy("source_no", "_block").orderBy("_key", "doc_id", "size")
    result = (
        named.join(blocks, ["source_no", "_block"])
        .withColumn("_before", F.col("_block_before") + F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
        .withColumn("_last", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before"))))
    )
    whole = (F.col("_last") == F.col("size")) & (F.col("size") > 0)
    copies = F.when(F.col("size") > 0, F.col("_passes")).otherwise(0) + whole.cast("int")
    part = F.when(whole, 0).otherwise(F.col("_last"))
    return result.withColumn("full_copies", copies.cast("int")).withColumn("part_words", part.cast("long")).select(
        "_key", "source", "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("_passes") * F.col("size") + F.col("_last")).cast("long").alias("taken"),
        "full_copies", "part_words",
        F.expr(
            f"transform(slice(_shards, 1, full_copies + if(part_words > 0, 1, 0)), (s, i) -> named_struct('shard', s, 'place', xxhash64({seed}, s, i, _key)))"
        ).alias("draws"),
    )


def mixed_documents(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is drawn, with all its columns.

    A partial copy keeps its first ``part_words`` words, joined by one space; where there is a column n_chars, it then counts
    the code points kept. Documents that are not drawn, among them all without words, are left out. Rows with the id, text and
    source of another are drawn like that one. Every partition is ordered by output shard and place in the shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    identity = F.struct(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text).alias("hash"), F.col("source").cast("string").alias("source"))
    drawn = _draws(docs, n_shards, seed).where(F.size("draws") > 0)
    drawn = drawn.groupBy(F.struct(F.col("_key").alias("hash"), "source").alias("_identity")).agg(F.max_by(F.struct("full_copies", "part_words", "draws"), F.size("draws")).alias("_drawn"))
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"), identity.alias("_identity"))
    joined = whole.join(drawn, (whole["_identity"]["hash"] == drawn["_identity"]["hash"]) & whole["_identity"]["source"].eqNullSafe(drawn["_identity"]["source"]))
    copies = joined.select("_doc", F.col("_drawn.full_copies").alias("_full"), F.col("_drawn.part_words").alias("_part"), F.posexplode("_drawn.draws").alias("_copy", "_draw"))
    cut = F.col("_copy") >= F.col("_full")
    words = F.regexp_extract_all(F.col("_doc.text"), F.lit(WORD), F.lit(0))
    shortened = F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(1), F.col("_part").cast("int"))), " ")
    copies = copies.sortWithinPartitions("_draw.shard", "_draw.place").withColumn("_text", F.when(cut, shortened).otherwise(F.col("_doc.text")))
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    for i, c in enumerate(docs.columns):
        if c == "text":
            columns[i] = F.col("_text").alias(c)
        elif c == "n_chars":
            columns[i] = F.when(cut, F.length("_text").cast(docs.schema[c].dataType)).otherwise(F.col("_doc.n_chars")).alias(c)
    return copies.select(*columns)
