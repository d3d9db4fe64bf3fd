"""Gold-layer aggregates: measure specs, group summaries, percentages, unpivots."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.derive import pct


@dataclass(frozen=True)
class Measure:
    """One aggregate column.

    ``fn`` is one of ``count`` (rows), ``count_col`` (non-null values),
    ``count_distinct``, ``approx_distinct``, ``sum``, ``avg``, ``min``,
    ``max``, ``count_if`` (``col`` is a predicate) or ``max_int`` (max of a
    flag cast to int). ``round`` rounds the result, half up, after noise
    beyond the eighth decimal is dropped. ``sum`` and ``avg`` work in doubles;
    with ``exact`` they add up ``decimal(38,12)`` values, so that the result
    does not depend on how rows were split across tasks. A group with a value
    that such a decimal cannot hold (NaN, an infinity, 1e26 or more) gets the
    double result: NaN and infinities propagate in either form.
    """

    name: str
    fn: str
    col: str | Column | None = None
    round: int | None = None
    exact: bool = False

    def _input(self) -> Column:
        return F.col(self.col) if isinstance(self.col, str) else self.col

    def _total(self) -> Column:
        """``sum`` or ``avg``; exact ones are doubles."""
        c = self._input()
        if not self.exact:
            return getattr(F, self.fn)(c)
        plain = getattr(F, self.fn)(c.cast("double"))
        wide = c.try_cast(EXACT_TYPE)
        total = F.sum(wide).cast("double")
        if self.fn == "avg":
            total = F.try_divide(total, F.count(wide))
        return F.when(F.count_if(c.isNotNull() & wide.isNull()) > 0, plain).otherwise(total)

    def expr(self) -> Column:
        fn = self.fn
        if fn == "count":
            out = F.count(F.lit(1))
        elif fn == "count_col":
            out = F.count(self._input())
        elif fn == "count_distinct":
            out = F.count_distinct(self._input())
        elif fn == "approx_distinct":
            out = F.approx_count_distinct(self._input())
        elif fn == "count_if":
            out = F.count_if(self._input())
        elif fn == "max_int":
            out = F.max(self._input().cast("int"))
        elif fn in ("sum", "avg"):
            out = self._total()
        elif fn in ("min", "max"):
            out = getattr(F, fn)(self._input())
        else:
            raise ValueError(f"unknown measure function {fn!r}")
        if self.round is not None:
            out = round_stable(out, self.round)
        return out.alias(self.name)


EXACT_TYPE = "decimal(38,12)"


def round_stable(c: Column, digits: int) -> Column:
    """Round a double half up on its value to eight decimals, so sums of doubles that differ in
    their last bits round alike; NaN, infinities and values too large for that round plainly."""
    return F.coalesce(F.round(c.try_cast("decimal(38,8)"), digits).cast("double"), F.round(c, digits))


def distinct_measure(name: str, col: str | Column, approximate: bool = False) -> Measure:
    """Exact ``count(DISTINCT col)``, or — when ``approximate`` — HyperLogLog++
    (``approx_count_distinct``, ~5% relative error by default), which ships a
    fixed-size sketch per group instead of every distinct value."""
    return Measure(name, "approx_distinct" if approximate else "count_distinct", col)


def measures_for(available: Sequence[str], spec: Mapping[str, Sequence[Measure]]) -> list[Measure]:
    """Measures whose source column exists: ``spec`` maps a column (or ``"*"``
    for always) to its measures; absent columns are skipped, as a dynamic
    gold table built from whatever the silver schema offers."""
    out: list[Measure] = []
    for column, ms in spec.items():
        if column == "*" or column in available:
            out.extend(ms)
    return out


def group_summary(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure],
                  order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``groupBy(keys).agg(measures)`` (two-phase: partial aggregate before the shuffle).

    Several exact distinct counts of columns of one type, with row counts or
    alone, go by (key, column, value): see `tagged_counts`. ``max_int`` of
    several boolean flags travels as the bits of one number: see `packed_flags`.
    """
    flags = _flags(df, measures)
    if _taggable(df, measures):
        out = tagged_counts(df, keys, measures)
    elif len(flags) > 1 and _named_apart(df, keys, measures):
        packed, values = packed_flags(flags)
        out = df.groupBy(*keys).agg(packed, *[m.expr() for m in measures if m.name not in values])
        out = out.select(*map(_column, out.columns[: len(keys)]), *[values.get(m.name, _column(m.name)) for m in measures])
    else:
        out = df.groupBy(*keys).agg(*[m.expr() for m in measures])
    return out.orderBy(*order_by) if order_by else out


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _named_apart(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure]) -> bool:
    names = [c.lower() for c in [*df.select(*keys).columns, *(m.name for m in measures), PACKED]]
    return len(set(names)) == len(names)


#: Flags that fit into one number, two bits each, and the name of that number.
FLAGS, PACKED = 31, "_flags"


def _flags(df: DataFrame, measures: Sequence[Measure]) -> list[Measure]:
    """The ``max_int`` measures of boolean columns, at most `FLAGS`."""
    ints = [m for m in measures if m.fn == "max_int" and m.round is None]
    types = [t for _, t in df.select(*[m._input().alias(str(i)) for i, m in enumerate(ints)]).dtypes] if ints else []
    return [m for m, t in zip(ints, types, strict=True) if t == "boolean"][:FLAGS]


def packed_flags(flags: Sequence[Measure]) -> tuple[Column, dict[str, Column]]:
    """Greatest values of boolean flags as one aggregate, and each as 0, 1 or null read from it.

    Bit 2k says that flag k was seen, bit 2k + 1 that it was true, so a
    shuffled row carries one number instead of one per flag.
    """
    bits = F.lit(0).cast("bigint")
    for k, m in enumerate(flags):
        seen = F.when(m._input(), F.lit(3 << 2 * k)).when(~m._input(), F.lit(1 << 2 * k)).otherwise(F.lit(0))
        bits = bits.bitwiseOR(seen.cast("bigint"))

    def value(k: int) -> Column:
        def bit(at: int) -> Column:
            return F.shiftright(F.col(PACKED), at).bitwiseAND(F.lit(1)).cast("int")
        return F.when(bit(2 * k) == 1, bit(2 * k + 1))

    return F.bit_or(bits).alias(PACKED), {m.name: value(k).alias(m.name) for k, m in enumerate(flags)}


def _taggable(df: DataFrame, measures: Sequence[Measure]) -> bool:
    distinct = [m for m in measures if m.fn == "count_distinct"]
    types = {t for _, t in df.select(*[m._input() for m in distinct]).dtypes} if distinct else set()
    return len(distinct) > 1 and len(types) == 1 and all(m.fn in ("count", "count_distinct") and m.round is None for m in measures)


def tagged_counts(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure]) -> DataFrame:
    """Exact distinct counts of several columns, and row counts, by ``keys``.

    Each row becomes one (key, column number, value) a counted column; these
    are counted first, then the different ones by key. Only such triples are
    shuffled, instead of a copy of the row a counted column, and a key with
    very many rows is spread over its values.
    """
    distinct = [m for m in measures if m.fn == "count_distinct"]
    tags = {m.name: k for k, m in enumerate(distinct)}
    values = [x for k, m in enumerate(distinct) for x in (F.lit(k), m._input())]
    rows = df.select(*keys, F.stack(F.lit(len(distinct)), *values).alias("_column", "_value"))
    names = rows.columns[: len(keys)]
    seen = rows.groupBy(*names, "_column", "_value").agg(F.count(F.lit(1)).alias("_rows"))

    def measure(m: Measure) -> Column:
        if m.fn == "count":
            return F.sum(F.when(F.col("_column") == 0, F.col("_rows"))).alias(m.name)
        return F.count_if((F.col("_column") == tags[m.name]) & F.col("_value").isNotNull()).alias(m.name)

    return seen.groupBy(*names).agg(*map(measure, measures))


def global_summary(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Aggregate without keys: one row."""
    return df.agg(*[m.expr() for m in measures])


def with_pct_of_total(df: DataFrame, count_col: str, name: str = "pct_of_total", scale: int = 2) -> DataFrame:
    """``count * 100 / total`` where ``total`` is the sum of ``count_col`` over ``df``.

    ``df`` holds one row per group of **all** rows; groups that the report
    leaves out are filtered afterwards. The total is a window over the grouped
    frame, so the input is read once and nothing runs before an action; one
    task sees one row per group, which suits report-sized groupings.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(name, pct(F.col(count_col), total, scale))


def with_completeness(df: DataFrame, pairs: Mapping[str, tuple[str, str]], scale: int = 2) -> DataFrame:
    """Within-group percentages: ``name → (part, whole)``."""
    return df.withColumns({n: pct(F.col(p), F.col(w), scale) for n, (p, w) in pairs.items()})


def unpivot_frequency(df: DataFrame, value_cols: Sequence[str], name_col: str, count_col: str, pct_col: str,
                      scale: int = 2) -> DataFrame:
    """Count 0/1 columns and list them as rows: ``sum(v)``, ``sum(v)*100/rows``; no rows for an empty frame.

    One global aggregate and a literal list of its columns: rows are never
    multiplied. Output is in the order of ``value_cols`` (e.g. weekday order).
    """
    sums = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_{i}") for i, v in enumerate(value_cols)])
    entries = F.array(*[
        F.struct(F.lit(v).alias(name_col), F.col(f"_{i}").alias(count_col), pct(F.col(f"_{i}"), F.col("_rows"), scale).alias(pct_col))
        for i, v in enumerate(value_cols)
    ])
    return sums.where("_rows > 0").select(F.inline(entries))


def union_tagged(frames: Mapping[str, DataFrame], tag_col: str) -> DataFrame:
    """Bag union by column name, each side tagged with its literal."""
    parts = [f.withColumn(tag_col, F.lit(tag)) for tag, f in frames.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def stacked_group_summary(df: DataFrame, tag_col: str, key_col: str, sources: Mapping[str, str],
                          measures: Sequence[Measure]) -> DataFrame:
    """Same result as ``union_tagged`` of one ``group_summary`` per source column,
    from a single scan and a single shuffle: each row is emitted once per
    source (tag, key) and one aggregate groups by (tag, key)."""
    pairs = F.array(*[F.struct(F.lit(t).alias(tag_col), F.col(c).alias(key_col)) for t, c in sources.items()])
    return (
        df.withColumn("_pair", F.explode(pairs)).select("*", "_pair.*").drop("_pair")
        .groupBy(tag_col, key_col).agg(*[m.expr() for m in measures])
    )


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows under ``order`` (each task keeps only its own top ``k``)."""
    return df.orderBy(*order).limit(k)
