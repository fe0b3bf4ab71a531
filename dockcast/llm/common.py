"""Expressions and table steps that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A key is hot above this share of all rows; so there are at most 1 / HOT_SHARE hot keys, and they can be broadcast.
HOT_SHARE = 1e-3

BATCH_ROWS = 2048


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; no word gives an empty array."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def count_between(text: Column, separators: str) -> Column:
    """The number of non-empty pieces between runs of separators; a split costs far less than extracting the pieces."""
    outer = lambda p: F.when(p == "", 1).otherwise(0)
    count = lambda p: F.greatest(F.lit(0), F.size(p) - outer(p[0]) - outer(F.element_at(p, -1)))
    return let(F.split(text, separators, -1), count).cast("long")


def n_words(text: Column) -> Column:
    return count_between(text, SPACE)


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else; the plain function does for texts of ASCII alone."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def computed_once(value: Column) -> Column:
    """The value, marked so that the optimizer neither copies its expression into later filters nor evaluates it again.

    A filter on a deep expression would otherwise be rewritten in terms of the table's columns, and grow with every
    reference inside it. The condition is always true, but not deterministic, which ends the rewriting.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def matches(text: Column, pattern: Column | str) -> Column:
    """All non-overlapping matches of a pattern from the left: array<struct<start, end, found>>, code points, end exclusive.

    A match starts where the gaps and matches before it end, so one split and one extraction give all places.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, regex, F.lit(0))
    gaps = F.split(text, regex, -1)
    lengths = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("found")))
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.aggregate(
        lengths,
        state,
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + F.length(x["found"])).alias("at"),
            F.concat(
                s["out"],
                F.array(F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + F.length(x["found"])).alias("end"), x["found"].alias("found"))),
            ).alias("out"),
        ),
        lambda s: s["out"],
    )


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of BATCH_ROWS meanwhile: rows with whole texts are large, and every task holds a batch on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps reuse it, and lost executors cost nothing twice."""
    with small_batches(df.sparkSession):
        return materialize(df, f"llm-{name}")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows LEFT JOIN groups on key, where a few keys may hold most rows.

    groups has one row per key and the number of rows with it. Keys above HOT_SHARE of all rows are at most
    1 / HOT_SHARE, so those groups go to every task; all other keys are joined by a shuffle. Rows without a group
    keep NULLs.
    """
    least = max(1, int(total * HOT_SHARE))
    hot = F.broadcast(groups.filter(F.col(size) > least))
    taken = [c for c in groups.columns if c != key]
    marked = rows.join(hot.withColumn("_hot", F.lit(True)), key, "left")
    done = marked.filter("_hot").drop("_hot")
    rest = marked.filter("_hot IS NULL").drop("_hot", *taken).join(groups.filter(F.col(size) <= least), key, "left")
    return done.unionByName(rest)


def join_known(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows JOIN groups on a long key, where a few keys may hold most rows: join_groups without the rows that have no group.

    As the sizes add up to `total` at most, a list of the hot keys tells rows apart before any join. So a row meets one
    join, and only rows with a group come out of it. groups should be a stored table: its hot keys are read first.
    """
    least = max(1, int(total * HOT_SHARE))
    hot = groups.filter(F.col(size) > least)
    keys = [r[0] for r in hot.select(key).collect()]
    if not keys:
        return rows.join(groups, key)
    is_hot = F.col(key).isin(keys)
    rest = rows.filter(~is_hot).join(groups.filter(F.col(size) <= least), key)
    return rows.filter(is_hot).join(F.broadcast(hot), key).unionByName(rest)


def screen(rows: DataFrame, key: Column, listed: DataFrame, bits: int) -> DataFrame:
    """rows with `_maybe`: false only where the long `key` is not in `listed` (one long column), so the row needs no join.

    The listed keys are marked in a bit table of 2^bits places (2^(bits - 6) rows, at most 2^18) that every task holds. The
    more keys, the more rows pass needlessly; none is missed.
    """
    bits = min(bits, 24)
    name = listed.columns[0]
    place = lambda k: k.bitwiseAND(F.lit((1 << bits) - 1))
    word = lambda k: F.shiftright(place(k), 6)
    bit = lambda k: place(k).bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(name)))
    table = listed.groupBy(word(F.col(name)).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    keyed = rows.withColumn("_screened", key)
    met = keyed.join(F.broadcast(table), word(F.col("_screened")) == F.col("_word"), "left")
    on = F.call_function("shiftrightunsigned", F.col("_bits"), bit(F.col("_screened"))).bitwiseAND(F.lit(1)) == 1
    return met.withColumn("_maybe", F.coalesce(on, F.lit(False))).drop("_word", "_bits", "_screened")


def first_of(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Rows whose flag is set keep it only once per key; for rows that are alike in all that decides."""
    order = Window.partitionBy(*keys).orderBy(F.monotonically_increasing_id())
    marked = rows.filter(flag).withColumn("_n", F.row_number().over(order)).withColumn(flag, F.col("_n") == 1).drop("_n")
    return marked.unionByName(rows.filter(~F.col(flag)))
