"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source is laid out as one line of words in a seeded order of its documents and cut into blocks of
``block`` words; a source of fewer than FINE blocks is cut into shorter ones of its own, at most FINE, of one
word at least, so that tiny sources get their share. The house has as many seats as the targets have blocks.
Seat j of a source has the quotient demand / (2 j + 1); the house takes the highest quotients, ties in order
of sources, and never more than ``most`` passes over a source. Houses of k shards are nested, so the steps
between them are the integer quotas of each shard: a source's quota in shard k is the run of its blocks after
those of shard k - 1. Runs go through the seeded order pass by pass, which makes them a random choice of
documents, and blocks stay arithmetic, never rows.

Only seats close to the cut are listed: every seat with a quotient above a bound is in, every one below
another is out, and between both lie about two seats per source.

Nulls, ties and odd rows: a null source is a source of its own, last in order; null and empty texts have
size 0 and take nothing; repeated rows are rows of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.layout import attach, digest, keyed, numbered, word_count
from tastegrid.operators.ordering import global_position, running_totals
from tastegrid.session import settle

# fixed values: weights in turn, share of all sizes, most times a source is repeated
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Words of a block; least blocks of a source; shards of the mix.
BLOCK, FINE, SHARDS = 64, 2048, 16
#: Digits of the seeded order that name a bucket (each is one window task per source); sources in a bucket of running sums.
BUCKET_DIGITS, RUN = 2, 4096


def seeded(seed: str, *cols: str) -> Column:
    """A hexadecimal key that orders rows at random, the same in every run."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in cols]))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, place, source_size, target from (source, size) rows.

    Sources in code point order (null last) weigh ``weights`` in turn. The level solves
    sum(min(level * weight, most * size)) = ``share`` of all sizes: in the order of cap / weight all sources
    before the first that the level does not fill are capped. Two single rows come to the driver.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_none", F.col("source").isNull())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = global_position(per, ["_none", "source"], "place")
    weighed = placed.select(
        "source", "place", "source_size",
        F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).cast("double").alias("cap"),
    )
    ranked = global_position(weighed.withColumn("_full", F.col("cap") / F.col("weight")), ["_full", "place"], "_rank")
    sums = running_totals(ranked, [], F.floor(F.col("_rank") / RUN), ["_rank"], {"cap": "_caps", "weight": "_weights"})
    table = settle(sums)
    total = table.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    held, open_ = F.col("_caps") - F.col("cap"), F.lit(total["weight"]) - F.col("_weights") + F.col("weight")
    raised = (F.lit(float(total["size"] or 0) * share) - held) / open_
    fits = table.where(raised * F.col("weight") <= F.col("cap"))
    level = fits.agg(F.min_by(raised, F.struct("_full", "place")).alias("level")).first()["level"]
    level = float("inf") if level is None else level
    target = F.when(F.col("cap") > 0, F.least(F.col("weight") * F.lit(level), F.col("cap"))).otherwise(F.lit(0.0))
    return table.select("source", "place", "source_size", target.alias("target"))


def cut_blocks(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``targets`` with length (words of the source's blocks), blocks of one pass, and demand, the target in blocks."""
    length = F.greatest(F.lit(1), F.least(F.lit(block), F.ceil(F.col("source_size") / F.lit(FINE))))
    cut = targets.withColumn("length", length).withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")))
    demand = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size"))
    return cut.withColumn("demand", F.coalesce(demand, F.lit(0.0)))


def shard_quotas(cut: DataFrame, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """source, edges: seats of the source in the nested houses of 0, 1 ... ``shards`` shards.

    ``edges[k + 1] - edges[k]`` is its quota in shard k. ``cut`` has one row per source; one row of sums comes
    to the driver, and one number per shard. A house is ranked in one window of about two rows per source.
    """
    cut = cut.select("source", "place", "blocks", "demand")
    whole = cut.agg(F.sum("demand").alias("demand"), F.count(F.lit(1)).alias("n"), F.sum("blocks").alias("blocks")).first()
    demand, n = whole["demand"] or 0.0, whole["n"]
    seats = min(int(demand + 0.5), (whole["blocks"] or 0) * most)
    houses = {k: seats * k // shards for k in range(1, shards + 1)}

    def held(divisor: dict[int, float]) -> Column:
        """Seats whose quotient is at least half the divisor of their house; none at an infinite one."""
        each = F.array(*[F.lit(divisor[k]) for k in houses])
        return F.least(F.floor(F.col("demand") / F.element_at(each, F.col("house")) + 0.5), F.col("blocks") * most)

    out = {k: demand / (h - n / 2 - 1) if h > n / 2 + 1 else float("inf") for k, h in houses.items()}
    copies = cut.withColumn("house", F.explode(F.array(*[F.lit(k) for k in houses]))).withColumn("sure", held(out))
    slack = n / 2 + 1
    while True:  # full sources take no more, so the others may need a lower bound
        low = {k: max(demand, 1e-300) / (h + slack) for k, h in houses.items()}
        listed = copies.withColumn("likely", held(low))
        sums = {r["house"]: r for r in listed.groupBy("house").agg(F.sum("sure").alias("sure"), F.sum("likely").alias("likely")).collect()}
        if all(r["likely"] >= houses[k] for k, r in sums.items()):
            break
        slack *= 2
    missing = F.array(*[F.lit(houses[k] - sums[k]["sure"] if k in sums else 0) for k in houses])
    near = listed.where("likely > sure").withColumn("seat", F.explode(F.sequence("sure", F.col("likely") - 1)))
    best = Window.partitionBy("house").orderBy(F.desc(F.col("demand") / (2 * F.col("seat") + 1)), "place", "seat")
    taken = near.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.element_at(missing, F.col("house")))
    more = taken.groupBy("place", "house").agg(F.count(F.lit(1)).alias("more"))
    both = listed.join(more, ["place", "house"], "left").withColumn("edge", F.col("sure") + F.coalesce("more", F.lit(0)))
    edges = F.sort_array(F.collect_list(F.struct("house", "edge")))  # one per shard
    per = both.groupBy("place").agg(F.first("source").alias("source"), edges.alias("_edges"))
    return per.select("source", F.concat(F.array(F.lit(0).cast("long")), F.col("_edges.edge")).alias("edges"))


def mix_sources(docs: DataFrame, block: int = BLOCK, seed: str = "mix", shards: int = SHARDS, most: int = MOST, **law) -> DataFrame:
    """doc_id, source, _digest, _copy, size, start, source_size, target, taken, shard_words.

    ``taken`` is what the mix takes of each row in words, ``shard_words`` the same for each shard. ``start`` is
    the row's first word on its source's line. The source with a third of all rows is spread over the buckets
    of the seeded order; offsets come from one row per (source, bucket).
    """
    text = F.col("text")
    rows = docs.select("doc_id", "source", digest(text).alias("_digest"), word_count(text).alias("size"))
    sized = settle(numbered(rows, "source").withColumn("_order", seeded(seed, "doc_id")))
    cut = settle(cut_blocks(source_targets(sized, most=most, **law), block))
    quotas = cut.alias("c").join(shard_quotas(cut, shards, most).alias("q"), F.expr("c.source <=> q.source")).select("c.*", "q.edges")
    bucket = F.substring("_order", 1, BUCKET_DIGITS)
    line = running_totals(sized, ["source"], bucket, ["_order", "doc_id", "size", "_digest", "_copy"], {"size": "_end"})
    line = line.withColumn("start", F.col("_end") - F.col("size")).drop("_end", "_order")
    both = attach(line, settle(quotas), ["source"], ["source_size", "target", "length", "blocks", "edges"])

    def words(edge: Column) -> Column:
        """Words of the row in the first ``edge`` seats of its source: whole passes, then the blocks of a started one."""
        reach = F.pmod(edge, F.col("blocks")) * F.col("length")
        begun = F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), reach) - F.col("start"))
        return F.when(F.col("blocks") > 0, F.floor(edge / F.col("blocks")) * F.col("size") + begun).otherwise(0).cast("long")

    reached = both.withColumn("_words", F.transform("edges", words))
    steps = F.zip_with(F.slice("_words", 2, shards), F.slice("_words", 1, shards), lambda a, b: a - b)
    out = reached.withColumn("taken", F.element_at("_words", -1)).withColumn("shard_words", steps)
    return out.drop("_words", "edges", "blocks", "length")


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken whole, then the words of a started pass.

    White space inside the cut text is kept. Only the document at the end of a source's run is cut.
    """
    named = mixed.select("doc_id", "source", "_digest", "_copy", F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    rows = attach(keyed(docs, "source"), named, ["doc_id", "source", "_digest", "_copy"], ["_size", "_taken"])
    whole = F.when(F.col("_size") > 0, F.floor(F.col("_taken") / F.col("_size"))).otherwise(0)
    rest = F.when(F.col("_size") > 0, F.col("_taken") % F.col("_size")).otherwise(0)
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.when(rest > 0, F.array_join(F.slice(pieces, 1, F.greatest(rest, F.lit(1)).cast("int")), ""))
    texts = F.array_compact(F.concat(F.array_repeat(F.col("text"), whole.cast("int")), F.array(cut)))
    out = rows.withColumn("_t", F.explode(texts))
    return out.select(*[F.col("_t").alias("text") if c == "text" else F.col(c) for c in docs.columns])
