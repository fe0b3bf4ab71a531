"""From mixed columns to a numeric feature table: JSON expansion, one-hot, alignment, screening, leak guard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.functions.values import to_numeric
from dockcast.operators.contracts import ContractError

JSON_SHARE = 0.6
MAX_CATEGORIES = 20
MIN_KNOWN_SHARE = 0.20
PERFECT_CORRELATION = 0.999999
_MAP = "map<string,string>"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def looks_like_json(c: Column) -> Column:
    text = F.trim(c)
    return text.startswith("{") & text.endswith("}")


def json_like_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of known values that look like a JSON object, over the whole column; one row per column."""
    shares = [F.avg(looks_like_json(F.col(c)).cast("double")).alias(c) for c in columns]
    return _transpose(df.agg(*shares), columns, "ratio")


def _transpose(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias(value)) for c in columns]
    return one_row.select(F.inline(F.array(*cells)))


def json_keys(df: DataFrame, column: str, most: int | None = None) -> list[str]:
    """The keys found in a JSON column, sorted: one column each. More than `most` is an error, never a cut; json_pairs() has no such need."""
    keys = df.select(F.explode(F.map_keys(F.from_json(column, _MAP))).alias("k")).distinct()
    found = (keys if most is None else keys.limit(most + 1)).collect()
    if most is not None and len(found) > most:
        raise ContractError(f"{column} holds more than {most} JSON keys")
    return sorted(row["k"] for row in found)


def json_pairs(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """The long form, for any number of keys: a row per kept columns, key and text value."""
    return df.select(*keep, F.explode(F.from_json(column, _MAP)).alias("key", "value"))


def json_values(column: str, keys: Sequence[str]) -> dict[str, Column]:
    """One number per key: true and false count as 1 and 0, anything else that is not a number as 0."""
    parsed = F.from_json(F.col(column), _MAP)
    out = {}
    for key in keys:
        text = parsed[key]
        flag = F.when(text == "true", 1.0).when(text == "false", 0.0)
        out[f"{column}_{key}"] = F.coalesce(flag, to_numeric(text), F.lit(0.0))
    return out


def categories(df: DataFrame, columns: Sequence[str], max_card: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values of the columns that have at most `max_card` of them.

    A sketch rules out wide columns first, so only sets of a few dozen values are collected.
    """
    if not columns:
        return {}
    return _value_sets(df, columns, df.agg(*[_width(c).alias(c) for c in columns]).first(), max_card)


def _width(c: str) -> Column:
    return F.approx_count_distinct(c, 0.02)


def _value_sets(df: DataFrame, columns: Sequence[str], widths: Mapping[str, int], max_card: int) -> dict[str, list[str]]:
    narrow = [c for c in columns if widths[c] <= 2 * max_card]
    if not narrow:
        return {}
    sets = df.agg(*[F.collect_set(c).alias(c) for c in narrow]).first()
    return {c: sorted(sets[c]) for c in narrow if len(sets[c]) <= max_card}


def onehot_columns(column: str, values: Sequence[str]) -> dict[str, Column]:
    """0/1 per value after the first; NULL gives 0 everywhere."""
    return {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values[1:]}


@dataclass(frozen=True)
class Encoding:
    """What was learnt from the training rows, so that every other table gets the same columns."""

    json: dict[str, list[str]] = field(default_factory=dict)
    onehot: dict[str, list[str]] = field(default_factory=dict)
    numeric: list[str] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        names = list(self.numeric)
        names += [f"{c}_{k}" for c, keys in self.json.items() for k in keys]
        names += [f"{c}_{v}" for c, values in self.onehot.items() for v in values[1:]]
        return names


def learn_encoding(df: DataFrame, exclude: Sequence[str] = (), onehot: bool = True) -> Encoding:
    """Find JSON columns and their keys, narrow text columns and their values, and numeric columns.

    `onehot=False` drops text columns as the original jobs do in effect: there the one-hot columns
    come out boolean and are then filtered away with the other non-numeric ones.
    """
    rest = df.drop(*exclude)
    texts = string_columns(rest)
    shares, widths = {}, {}
    if texts:
        json_share = [F.avg(looks_like_json(F.col(c)).cast("double")) for c in texts]
        seen = rest.agg(*json_share, *[_width(c) for c in texts]).first()
        shares, widths = dict(zip(texts, seen)), dict(zip(texts, seen[len(texts) :], strict=True))
    json_cols = [c for c in texts if shares[c] is not None and shares[c] >= JSON_SHARE]
    keys = {c: json_keys(rest, c) for c in json_cols}
    plain = [c for c in texts if not keys.get(c)]
    found = _value_sets(rest, plain, widths, MAX_CATEGORIES) if onehot else {}
    return Encoding(keys, found, numeric_columns(rest))


def encode(df: DataFrame, encoding: Encoding, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and every learnt feature as a double without NULL; absent source columns give 0."""
    columns: dict[str, Column] = {}
    for c in encoding.numeric:
        columns[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    for c, keys in encoding.json.items():
        columns |= json_values(c, keys) if c in df.columns else {f"{c}_{k}": F.lit(0.0) for k in keys}
    for c, values in encoding.onehot.items():
        known = onehot_columns(c, values) if c in df.columns else {f"{c}_{v}": F.lit(0) for v in values[1:]}
        columns |= {name: flag.cast("double") for name, flag in known.items()}
    return df.select(*keep, *[expr.alias(name) for name, expr in columns.items()])


def numeric_features(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Numeric columns only, NULL as 0."""
    names = [c for c in numeric_columns(df) if c not in exclude]
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])


def align_schema(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected feature columns in their order: missing ones are 0, others are dropped."""
    cells = [
        (F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c) for c in expected
    ]
    return df.select(*keep, *cells)


def screen_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known share, population variance and the keep decision per numeric column, in one pass."""
    stats = [
        F.struct(F.avg(F.col(c).isNotNull().cast("double")).alias("known_share"), F.var_pop(F.col(c).cast("double")).alias("variance")).alias(c)
        for c in columns
    ]
    wide = _transpose(df.agg(*stats), columns, "s").select("feature", "s.*")
    keep = (F.col("known_share") >= MIN_KNOWN_SHARE) & (F.coalesce(F.col("variance"), F.lit(0.0)) > 0)
    return wide.withColumn("keep", keep)


def leak_guard(df: DataFrame, y: str, columns: Sequence[str]) -> DataFrame:
    """Which features give the target away: by name, by being equal to it, or by perfect correlation; one pass.

    A constant feature has no correlation and is kept.
    """
    target = F.col(y).cast("double")
    filled = F.coalesce(target, F.lit(0.0))
    spread = F.stddev_pop(filled)
    stats = []
    for c in columns:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        stats.append(
            F.struct(
                F.bool_and(x.eqNullSafe(target)).alias("is_equal"),
                F.try_divide(F.covar_pop(x, filled), F.stddev_pop(x) * spread).alias("corr"),
            ).alias(c)
        )
    wide = _transpose(df.agg(*stats), columns, "s").select("feature", "s.*")
    named = F.contains(F.lower("feature"), F.lit(y.lower()))
    perfect = F.coalesce(F.abs("corr") > PERFECT_CORRELATION, F.lit(False))
    return wide.select(
        "feature", named.alias("by_name"), "is_equal", perfect.alias("by_corr"), (~(named | F.col("is_equal") | perfect)).alias("keep")
    )


def kept_features(report: DataFrame) -> list[str]:
    """The names a screening report keeps; one row per column of a table."""
    return [row["feature"] for row in report.where("keep").select("feature").collect()]


def feature_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct count per column, each column aggregated on its own values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    return values.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
