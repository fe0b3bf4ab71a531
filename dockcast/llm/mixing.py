"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target; a document's expected copies are its source's target over its source's size. The whole part
is taken as it is. The fractions are rounded in pairs: mass (in words) moves at random from one document of the pair to
the other until one of them is 0 or 1, so the words of a source stay as they are and every document keeps its
expectation. Documents are dealt into buckets of bounded size; each bucket leaves at most one fraction, and those
are dealt into buckets again, a reduction tree that ends with one fraction per source. That one is drawn, so a source's
words differ from its target by less than one document.

All draws are hashes of the seed and ids, so reruns agree.

Defined results: NULL text has size 0; a document of size 0 takes 0; NULL source is a source of its own, last in order;
rows equal in id, source and text are rounded as one unit and get the same copies; an empty table gives no rows; other
columns pass through unless they have the name of a result column, which is replaced.
Very long texts count all their words; a size above a source's target is taken or not like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import join_groups, let, n_words, store, whole_text

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Units that meet in one bucket of the tree, about.
BUCKET = 256
UNIT = "struct<id:struct<doc_id:bigint,key:string,hash:bigint>,p:double,w:double>"


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """What the mix needs of the documents: id, source, a hash of the text, and the size in words."""
    t = whole_text(text)
    return docs.select("doc_id", "source", _key().alias("_key"), F.xxhash64(t).alias("_hash"), n_words(t).alias("size"))


def _key() -> Column:
    """The source as a key that is never NULL."""
    return F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: `source_size`, `n_rows` and `target`.

    The shares solve sum(min(most * size, weight * level)) = all sizes. In the order of most * size / weight the sources
    that stop at their limit come first, so running sums over the table of sources (one row each) give the level.
    """
    by = sizes.groupBy("source", "_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights)))))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sums = weighed.select(
        "*",
        F.row_number().over(order).alias("_i"),
        (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_open"),
    )
    level = F.col("_left").cast("double") / F.col("_open")
    free = level * F.col("weight") <= most * F.col("source_size")
    return (
        sums.withColumn("_free", free)
        .withColumn("_level", F.min_by(F.when(free, level), F.when(free, F.col("_i"))).over(everything))
        .withColumn("target", F.when(F.col("_free"), F.col("_level") * F.col("weight")).otherwise((most * F.col("source_size")).cast("double")))
        .select("_key", "source_size", "n_rows", "target")
    )


def _draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its parts."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11) / F.lit(float(1 << 53))


def _meet(state: Column, unit: Column, seed: int) -> Column:
    """The open unit meets the next one: one of them becomes 0 or 1 and is done, the other stays open."""

    def settle(x: Column) -> Column:
        i, j = x["i"], x["j"]
        moved = lambda u, p: F.struct(u["id"].alias("id"), p.alias("p"), u["w"].alias("w"))
        done = lambda u, up: F.struct(u["id"].alias("id"), F.lit(up).alias("up"))
        result = lambda open_, end: F.struct(open_.alias("open"), F.concat(state["done"], F.array(end)).alias("done"))
        a, b = x["a"], x["b"]
        to_i = F.when(i["w"] * (1 - i["p"]) <= j["w"] * j["p"], result(moved(j, j["p"] - a / j["w"]), done(i, 1))).otherwise(
            result(moved(i, i["p"] + a / i["w"]), done(j, 0))
        )
        to_j = F.when(i["w"] * i["p"] <= j["w"] * (1 - j["p"]), result(moved(j, j["p"] + b / j["w"]), done(i, 0))).otherwise(
            result(moved(i, i["p"] - b / i["w"]), done(j, 1))
        )
        return F.when(_draw(seed, i["id"], j["id"]) * (a + b) < b, to_i).otherwise(to_j)

    i, j = state["open"], unit
    pair = F.struct(
        i.alias("i"), j.alias("j"),
        F.least(i["w"] * (1 - i["p"]), j["w"] * j["p"]).alias("a"),
        F.least(i["w"] * i["p"], j["w"] * (1 - j["p"])).alias("b"),
    )
    first = F.struct(unit.alias("open"), state["done"].alias("done"))
    return F.when(i.isNull(), first).otherwise(let(pair, settle))


def _reduce(units: DataFrame, seed: int) -> DataFrame:
    """Per bucket: the finished units, and the one that is still open. Large units meet first, so the small ones settle the rest."""
    empty = F.struct(F.lit(None).cast(UNIT).alias("open"), F.array().cast("array<struct<id:struct<doc_id:bigint,key:string,hash:bigint>,up:int>>").alias("done"))
    listed = units.groupBy("_key", "_bucket", "_buckets").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("order"), "id", "p", "w"))).alias("units")
    )
    bare = F.transform("units", lambda u: F.struct(u["id"].alias("id"), u["p"].alias("p"), u["w"].alias("w")))
    return listed.select("_key", "_bucket", "_buckets", F.aggregate(bare, empty, lambda s, u: _meet(s, u, seed)).alias("r")).select(
        "_key", "_bucket", "_buckets", "r.open", "r.done"
    )


def round_copies(units: DataFrame, largest: int, seed: int = 1) -> DataFrame:
    """Units (id, _key, p, w, n: units of the source) to (id, up): 0 or 1, with the sum of w * up per source kept to one unit.

    `largest` is the most units of one source; it gives the depth of the tree.
    """
    buckets = F.ceil(F.col("n") / BUCKET)
    dealt = units.select("id", "p", "w", "_key", buckets.alias("_buckets")).withColumn(
        "_bucket", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("_buckets"))
    )
    done = []
    left = math.ceil(max(1, largest) / BUCKET)
    while True:
        level = store(_reduce(dealt, seed), "mix-level")
        done.append(level.select(F.explode("done").alias("d")).select("d.id", "d.up"))
        rest = level.filter("open IS NOT NULL")
        if left <= 1:
            drawn = (_draw(seed, F.col("open.id")) < F.col("open.p")).cast("int")
            done.append(rest.select("open.id", drawn.alias("up")))
            break
        left = math.ceil(left / BUCKET)
        fewer = F.ceil(F.col("_buckets") / BUCKET)
        dealt = rest.select("open.id", "open.p", "open.w", "_key", fewer.alias("_buckets"), F.col("_bucket").alias("_b")).withColumn(
            "_bucket", F.pmod(F.col("_b"), F.col("_buckets"))
        )
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def mix(sizes: DataFrame, seed: int = 1, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of sized() with `source_size`, `target` and `copies`."""
    rows = store(sizes, "mix-sizes")
    goal = store(targets(rows, weights, most), "mix-targets")
    total, largest = goal.agg(F.sum("n_rows"), F.max("n_rows")).first()
    known = join_groups(rows, goal, "_key", "n_rows", total or 0)
    x = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = known.withColumn("_x", x).withColumn("_whole", F.floor("_x")).withColumn("_p", F.col("_x") - F.col("_whole"))
    ident = F.struct("doc_id", F.col("_key").alias("key"), F.col("_hash").alias("hash"))
    units = (
        known.filter("_p > 0 AND size > 0")
        .groupBy(ident.alias("id"), "_key", "_p", "n_rows")
        .agg(F.sum("size").cast("double").alias("w"))
        .select("id", "_key", F.col("_p").alias("p"), "w", F.col("n_rows").alias("n"))
    )
    up = round_copies(units, largest or 0, seed).select(
        F.col("id.doc_id").alias("_id"), F.col("id.key").alias("_k"), F.col("id.hash").alias("_h"), "up"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("_hash") == F.col("_h"))
    return known.join(up, same, "left").select(
        "doc_id", "source", "_key", "_hash", "size", "source_size", "target", (F.col("_whole") + F.coalesce("up", F.lit(0))).alias("copies")
    )


def mix_documents(docs: DataFrame, seed: int = 1, text: str = "text") -> DataFrame:
    """The documents of the mix: each with all its columns, as many times as it has copies."""
    chosen = mix(sized(docs, text), seed).filter("copies > 0").select("doc_id", "_key", "_hash", "copies").distinct()
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "copies")
    tagged = docs.withColumns({"_key": _key(), "_hash": F.xxhash64(whole_text(text))})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("_hash") == F.col("_h"))
    return tagged.join(chosen, same).select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")
