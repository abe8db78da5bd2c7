"""The rows at given places of an order, without sorting the table.

A sample of bounded size brackets each place, one pass counts the rows before the brackets exactly,
and the search goes on inside them until few enough rows are left to be looked at one by one. Only
samples and counts reach the driver; what is found is exact. Each round leaves about a hundredth of
the rows, so a billion rows take three passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Rows that the driver looks at, at a time.
SAMPLE_ROWS = 20_000

# Expressions to order by, each with whether it descends.
Order = list[tuple[Column, bool]]


def sorting(order: Order) -> list[Column]:
    return [c.desc() if descending else c.asc() for c, descending in order]


def _less(column: Column, value, descending: bool) -> Column:
    """Missing values come first, or last if the order descends."""
    if descending:
        return column.isNotNull() if value is None else F.coalesce(column > F.lit(value), F.lit(False))
    return F.lit(False) if value is None else F.coalesce(column < F.lit(value), F.lit(True))


def before(order: Order, values: Row | tuple) -> Column:
    """Whether a row comes before the key ``values``."""
    out, same = F.lit(False), F.lit(True)
    for (column, descending), value in zip(order, values, strict=True):
        out = out | (same & _less(column, value, descending))
        same = same & column.eqNullSafe(F.lit(value))
    return out


def equal(order: Order, values: Row | tuple) -> Column:
    return reduce(lambda a, b: a & b, [c.eqNullSafe(F.lit(v)) for (c, _), v in zip(order, values, strict=True)])


@dataclass
class _Part:
    """Consecutive rows of the order, those that pass the filters, and the places among them."""

    start: int
    rows: int
    places: list[int]
    key: tuple | None = None
    filters: list[Column] = field(default_factory=list)


def between_values(column: Column, descending: bool, first, last) -> Column:
    """Whether a value is neither before ``first`` nor behind ``last`` in the order of the column."""
    low, high = (last, first) if descending else (first, last)
    above = F.lit(True) if low is None else F.coalesce(column >= F.lit(low), F.lit(False))
    below = column.isNull() if high is None else F.coalesce(column <= F.lit(high), F.lit(low is None))
    return above & below


def in_order(value) -> tuple:
    """Values in Spark's order: missing ones first, NaN after all numbers."""
    if value is None:
        return (0,)
    return (2,) if value != value else (1, value)


def few_keys(table: DataFrame, order: Order, sample_rows: int = SAMPLE_ROWS) -> list[tuple] | None:
    """All keys in order if the table has at most ``sample_rows`` rows, else None; one job."""
    names = [f"_k{i}" for i in range(len(order))]
    some = table.select(*[c.alias(n) for n, (c, _) in zip(names, order, strict=True)]).limit(sample_rows + 1).collect()
    if len(some) > sample_rows:
        return None
    rows = [tuple(r) for r in some]
    for i, (_, descending) in reversed(list(enumerate(order))):
        rows.sort(key=lambda r, i=i: in_order(r[i]), reverse=descending)
    return rows


def keys_at(table: DataFrame, order: Order, places: list[int], sample_rows: int = SAMPLE_ROWS) -> dict[int, tuple]:
    """The key of the row at each place, counted from 0; places beyond the table are left out.

    Reads ``table`` several times: pass a written one.
    """
    names = [f"_k{i}" for i in range(len(order))]
    keys = table.select(*[c.alias(n) for n, (c, _) in zip(names, order, strict=True)])
    by = [(F.col(n), descending) for n, (_, descending) in zip(names, order, strict=True)]
    few = few_keys(keys, by, sample_rows)
    if few is not None:
        return {p: few[p] for p in places if 0 <= p < len(few)}
    total = keys.count()
    todo, found, seed = [_Part(0, total, sorted({p for p in places if 0 <= p < total}))], {}, 0
    while todo:
        part = todo.pop()
        if not part.places:
            continue
        if part.key is not None:
            found |= dict.fromkeys(part.places, part.key)
            continue
        rows = reduce(DataFrame.filter, part.filters, keys)
        if part.rows <= sample_rows:
            some = rows.orderBy(*sorting(by)).collect()
            found |= {p: tuple(some[p - part.start]) for p in part.places}
            continue
        seed += 1
        some = rows.filter(F.rand(seed) < sample_rows / part.rows).orderBy(*sorting(by)).collect()
        todo += _cut(part, rows, [tuple(r) for r in some], by)
    return found


def _cut(part: _Part, rows: DataFrame, sample: list[tuple], by: Order) -> list[_Part]:
    """The parts between the keys of the sample that bracket the places of ``part``."""
    if not sample:
        return [part]
    spread = 2 + int(2 * len(sample) ** 0.5)
    cuts = []
    for p in part.places:
        middle = (p - part.start) * len(sample) // part.rows
        cuts += [max(0, middle - spread), min(len(sample) - 1, middle + spread)]
    keys = list(dict.fromkeys(sample[i] for i in sorted(set(cuts))))
    counts = rows.agg(
        *[F.count(F.when(before(by, k), 1)) for k in keys], *[F.count(F.when(equal(by, k), 1)) for k in keys]
    ).first()
    out, low, at = [], None, 0

    def add(key, until: int, high) -> None:
        filters = [f for f in (low, high) if f is not None]
        places = [p for p in part.places if part.start + at <= p < part.start + until]
        out.append(_Part(part.start + at, until - at, places, key=key, filters=[*part.filters, *filters]))

    for i, key in enumerate(keys):
        less, same = counts[i], counts[len(keys) + i]
        add(None, less, before(by, key))
        at = less
        add(key, less + same, None)
        at, low = less + same, ~(before(by, key) | equal(by, key))
    add(None, part.rows, None)
    return out


def quantiles(table: DataFrame, column: str, shares: list[float], sample_rows: int = SAMPLE_ROWS) -> list:
    """The exact value at each share: of n values that are not missing, the one of rank ceil(share * n).

    Reads ``table`` several times: pass a written one.
    """
    return quantiles_of(table, [column], shares, sample_rows)[column]


@dataclass
class _Bracket:
    """The values of a column strictly between two others, and the ranks among them that are wanted."""

    column: str
    rows: int
    places: list[int]
    low: object = None
    high: object = None

    def inside(self) -> Column:
        value = F.col(self.column)
        above = F.lit(True) if self.low is None else value > F.lit(self.low)
        below = F.lit(True) if self.high is None else value < F.lit(self.high)
        return value.isNotNull() & above & below


def quantiles_of(
    table: DataFrame, columns: list[str], shares: list[float], sample_rows: int = SAMPLE_ROWS
) -> dict[str, list]:
    """``quantiles`` of many columns at once: every pass over the table narrows the brackets of all of them.

    A pass samples each bracket or, if few enough values are left, takes them whole; a second one
    counts exactly before the values that the samples propose. The number of passes depends on the
    rows, not on the columns; samples share ``sample_rows`` values. Values of one type per call.
    """
    totals = table.agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)]).first()
    places = {c: [max(1, -int(-share * n // 1)) - 1 for share in shares] for c, n in zip(columns, totals, strict=True)}
    todo = [_Bracket(c, n, sorted(set(places[c]))) for c, n in zip(columns, totals, strict=True) if n]
    starts = {id(b): 0 for b in todo}
    found: dict[tuple[str, int], object] = {}
    seed = 0
    while todo:
        seed += 1
        some = _samples(table, todo, sample_rows, seed)
        proposed: list[tuple[_Bracket, list]] = []
        for bracket, values in zip(todo, some, strict=True):
            if len(values) == bracket.rows:
                found |= {(bracket.column, p): values[p - starts[id(bracket)]] for p in bracket.places}
            else:
                proposed.append((bracket, _cuts(bracket, values, starts[id(bracket)])))
        if not proposed:
            break
        aggregates = [
            F.count(F.when(bracket.inside() & test, 1))
            for bracket, cuts in proposed
            for cut in cuts
            for test in (F.col(bracket.column) < F.lit(cut), F.col(bracket.column) == F.lit(cut))
        ]
        counts = iter(table.agg(*aggregates).first() if aggregates else ())
        todo, starts_then, starts = [], starts, {}
        for bracket, cuts in proposed:
            at, low = starts_then[id(bracket)], bracket.low
            ends = [(cut, next(counts), next(counts)) for cut in cuts]
            first = at
            for cut, less, same in [*ends, (bracket.high, bracket.rows, 0)]:
                inner = _Bracket(bracket.column, first + less - at, [p for p in bracket.places if at <= p < first + less], low, cut)
                if inner.places:
                    todo.append(inner)
                    starts[id(inner)] = at
                at = first + less
                found |= {(bracket.column, p): cut for p in bracket.places if at <= p < at + same}
                at, low = at + same, cut
    return {c: [found.get((c, p)) for p in places[c]] for c in columns}


def _samples(table: DataFrame, brackets: list[_Bracket], sample_rows: int, seed: int) -> list[list]:
    """Sorted values of each bracket: all, or a random part, of which ``sample_rows`` in all are expected."""
    most = max(1, sample_rows // len(brackets))
    parts = []
    for number, bracket in enumerate(brackets):
        drawn = F.lit(True) if bracket.rows <= most else F.rand(seed * 1009 + number) < most / bracket.rows
        value = F.struct(F.lit(number).alias("number"), F.col(bracket.column).alias("value"))
        parts.append(F.when(bracket.inside() & drawn, value))
    out: list[list] = [[] for _ in brackets]
    for row in table.select(F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p")).select("p.*").collect():
        out[row["number"]].append(row["value"])
    return [sorted(values, key=in_order) for values in out]


def _cuts(bracket: _Bracket, sample: list, start: int) -> list:
    """Values of the sample that the wanted ranks of a bracket most likely lie between."""
    if not sample:
        return []
    spread = 2 + int(2 * len(sample) ** 0.5)
    cuts = set()
    for p in bracket.places:
        middle = (p - start) * len(sample) // bracket.rows
        cuts |= {max(0, middle - spread), min(len(sample) - 1, middle + spread)}
    return list(dict.fromkeys(sample[i] for i in sorted(cuts)))
