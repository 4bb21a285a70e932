"""Semantic metric layer (SM1-SM4, SM7): a declarative model compiled to DataFrame calls.

The model is plain data (dicts, optionally loaded from YAML): logical tables
with a source, a primary key, dimension columns, fact columns and metric
expressions written in Spark SQL, plus many-to-one relationships. A metric
query picks the fact that owns the metrics, joins only the dimension tables
whose columns are asked for (no unused joins, so nothing for the optimizer to
eliminate), groups and aggregates. Metrics from several facts are answered by
``drill_across``: aggregate each fact on its own, then a null-safe full outer
join of the small results on the shared dimensions -- no fan-out.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass
class Metric:
    expr: str           # Spark SQL aggregate expression over the table's columns
    dtype: str = "long"  # result type after the expression
    # Decomposed form for eager aggregation: partial aggregates over fact rows
    # (name -> expr) and a final aggregate over them ({name} placeholders).
    partials: dict[str, str] | None = None
    final: str | None = None
    flag: str | None = None  # of a rate: the condition that its numerator counts


@dataclass
class LogicalTable:
    name: str
    source: Callable[..., DataFrame]   # (tables, columns=None) -> DataFrame
    primary_key: list[str]
    dimensions: list[str]
    facts: list[str] = field(default_factory=list)
    metrics: dict[str, Metric] = field(default_factory=dict)
    sample_values: dict[str, list[str]] = field(default_factory=dict)
    prunable: bool = True              # source accepts a ``columns`` list
    scope_date: str | None = None      # the date that says what time a rate covers


@dataclass
class Relationship:
    name: str
    left: str
    right: str
    left_column: str
    right_column: str
    kind: str = "many_to_one"


class ModelError(ValueError):
    pass


@dataclass
class Model:
    tables: dict[str, LogicalTable]
    relationships: list[Relationship]

    # -- SM1 --------------------------------------------------------------------
    def check_sources(self, t) -> "Model":
        """Hold every table's columns against those its source really has."""
        return self.validate({n: x.source(t).columns for n, x in self.tables.items()})

    def validate(self, schemas: dict[str, list[str]] | None = None) -> "Model":
        """Reject unknown tables/columns, duplicate names, missing keys, bad relations."""
        for t in self.tables.values():
            if not t.primary_key:
                raise ModelError(f"{t.name}: missing primary key")
            names = t.dimensions + t.facts + list(t.metrics)
            dup = {n for n in names if names.count(n) > 1}
            if dup:
                raise ModelError(f"{t.name}: duplicate names {sorted(dup)}")
            cols = t.dimensions + t.facts
            for k in t.primary_key:
                if k not in cols:
                    raise ModelError(f"{t.name}: key {k} is not a column")
            if schemas and t.name in schemas:
                missing = [c for c in cols if c not in schemas[t.name]]
                if missing:
                    raise ModelError(f"{t.name}: unknown columns {missing}")
        for r in self.relationships:
            if r.left not in self.tables or r.right not in self.tables:
                raise ModelError(f"{r.name}: unknown table")
            if r.kind != "many_to_one":
                raise ModelError(f"{r.name}: only many_to_one is supported")
            if r.right_column not in self.tables[r.right].primary_key:
                raise ModelError(f"{r.name}: right column must be the right table's key")
            lt = self.tables[r.left]
            if r.left_column not in lt.dimensions + lt.facts:
                raise ModelError(f"{r.name}: unknown column {r.left_column}")
        return self

    def owner_of(self, metric: str) -> str:
        owners = [t.name for t in self.tables.values() if metric in t.metrics]
        if not owners:
            raise ModelError(f"unknown metric {metric}")
        return owners[0]

    def relation(self, left: str, right: str) -> Relationship:
        for r in self.relationships:
            if r.left == left and r.right == right:
                return r
        raise ModelError(f"no relationship {left} -> {right}")


def _parse_dim(model: Model, base: str, dim: str) -> tuple[str, str, str | None, str]:
    """'carriers.carrier_name', 'carrier_name', 'ship_date:month' -> (table, column, grain, alias)."""
    alias = None
    if " as " in dim:
        dim, alias = [s.strip() for s in dim.split(" as ")]
    grain = None
    if ":" in dim:
        dim, grain = dim.split(":")
        if grain not in GRAINS:
            raise ModelError(f"unknown grain {grain}")
    if "." in dim:
        table, column = dim.split(".")
    else:
        column = dim
        candidates = [base] + [r.right for r in model.relationships if r.left == base]
        hits = [t for t in candidates if column in model.tables[t].dimensions + model.tables[t].facts]
        if not hits:
            raise ModelError(f"dimension {dim} not reachable from {base}")
        table = hits[0]
    return table, column, grain, alias or (f"{column}_{grain}" if grain else column)


def _grain(c: Column, grain: str | None) -> Column:
    if grain is None:
        return c
    if grain == "day":
        return c.cast("date")
    return F.date_trunc(grain, c).cast("date")


def metric_query(model: Model, t, metrics: list[str], dims: list[str] = (),
                 where: Column | None = None, where_columns: list[str] = (),
                 order: list[Column] | None = None, limit: int | None = None,
                 extra_aggs: dict[str, Column] | None = None, scope: bool = False) -> DataFrame:
    """SM2: metrics of one fact grouped by dimensions of the fact or its dims.

    ``where`` may name fact columns or joined dimension columns; the fact columns
    it names are kept. A filter on fact columns alone is applied to the fact before
    anything else. ``scope`` adds what a rate is a rate of (SM7). ``where_columns`` are further fact columns that ``extra_aggs`` use.
    """
    if not metrics:
        raise ModelError("no metrics")
    base = model.owner_of(metrics[0])
    if any(model.owner_of(m) != base for m in metrics):
        raise ModelError("metrics from several facts: use drill_across")
    bt = model.tables[base]
    if scope:
        more = _scope(bt, metrics)
        bt, metrics = replace(bt, metrics={**bt.metrics, **more}), [*metrics, *more]
    parsed = [_parse_dim(model, base, d) for d in dims]
    # Columns the fact must provide: own dims, join keys, metric inputs, filters.
    need = {c for (tb, c, _, _) in parsed if tb == base}
    joins = sorted({tb for (tb, _, _, _) in parsed if tb != base})
    rels = [model.relation(base, j) for j in joins]
    need |= {r.left_column for r in rels}
    need |= set(where_columns)
    own = bt.dimensions + bt.facts
    named = {c for c in own if where is not None and _mentions(str(where), c)}
    others = [c for r in rels for c in model.tables[r.right].dimensions + model.tables[r.right].facts]
    fact_only = named and not any(_mentions(str(where), c) for c in others if c not in own)
    need |= named
    for m in metrics:
        need |= {c for c in bt.dimensions + bt.facts if _mentions(bt.metrics[m].expr, c)}
    cols = [c for c in bt.dimensions + bt.facts if c in need]
    df = bt.source(t, columns=cols) if bt.prunable else bt.source(t).select(*cols)
    if fact_only:
        df, where = df.where(where), None
    eager = (rels and not extra_aggs and (where is None or not named)
             and all(bt.metrics[m].partials for m in metrics))
    if eager:
        return _eager(model, t, bt, df, metrics, parsed, rels, where, order, limit)
    for r in rels:
        dt = model.tables[r.right]
        dcols = {r.right_column} | {c for (tb, c, _, _) in parsed if tb == r.right}
        dim = dt.source(t).select(*sorted(dcols))
        if r.left_column != r.right_column:
            dim = dim.withColumnRenamed(r.right_column, r.left_column)
        # many-to-one left join: keeps every fact row (unmatched -> NULL dims).
        df = df.join(dim, r.left_column, "left")
    if where is not None:
        df = df.where(where)
    group = [_grain(F.col(c), g).alias(a) for (_, c, g, a) in parsed]
    aggs = [F.expr(bt.metrics[m].expr).cast(bt.metrics[m].dtype).alias(m.lower()) for m in metrics]
    aggs += [c.alias(n) for n, c in (extra_aggs or {}).items()]
    out = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    if order is not None:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out


def _scope(table: LogicalTable, metrics: list[str]) -> dict[str, Metric]:
    """SM7: per rate its numerator; the rows it covers, and the first and last date
    among them."""
    out = {f"{m}_NUMERATOR": Metric(f"count_if({f})", "long", {"n": f"count_if({f})"}, "sum({n})")
           for m in metrics if (f := table.metrics[m].flag)}
    out["SCOPE_ROWS"] = Metric("count(*)", "long", {"n": "count(*)"}, "sum({n})")
    if d := table.scope_date:
        for word, fn in (("FIRST", "min"), ("LAST", "max")):
            out[f"{word}_{d.upper()}"] = Metric(f"{fn}({d})", "date", {"d": f"{fn}({d})"}, f"{fn}({{d}})")
    return out


def _dim_table(model: Model, t, r: Relationship, parsed) -> DataFrame:
    dt = model.tables[r.right]
    dcols = {r.right_column} | {c for (tb, c, _, _) in parsed if tb == r.right}
    dim = dt.source(t).select(*sorted(dcols))
    if r.left_column != r.right_column:
        dim = dim.withColumnRenamed(r.right_column, r.left_column)
    return dim


def _eager(model, t, bt, df, metrics, parsed, rels, where, order, limit) -> DataFrame:
    """Eager aggregation: aggregate the fact by its own group keys and the
    foreign keys first, join the (now one-row-per-key) result to the
    dimensions, then finish the aggregation on the requested dimensions.

    Dimension attributes depend only on their key, so the result equals
    join-then-aggregate; but the join sees one row per key instead of one per
    fact row, and the fact side is reduced map-side before any shuffle -- a hot
    key (a third of all rows on one carrier) arrives as a handful of partial
    rows. Used when every metric has a decomposed (partials, final) form.
    """
    own = [(c, g, a) for (tb, c, g, a) in parsed if tb == bt.name]
    keys = [_grain(F.col(c), g).alias(a) for (c, g, a) in own]
    keys += [F.col(r.left_column) for r in rels if r.left_column not in [a for _, _, a in own]]
    partial_cols, finals = [], []
    for m in metrics:
        met = bt.metrics[m]
        names = {}
        for pn, pe in met.partials.items():
            col_name = f"__{m.lower()}_{pn}"
            names[pn] = col_name
            partial_cols.append(F.expr(pe).alias(col_name))
        finals.append(F.expr(met.final.format(**names)).cast(met.dtype).alias(m.lower()))
    pre = df.groupBy(*keys).agg(*partial_cols)
    for r in rels:
        pre = pre.join(_dim_table(model, t, r, parsed), r.left_column, "left")
    if where is not None:
        pre = pre.where(where)
    group = [F.col(a) for (_, _, _, a) in parsed]
    out = pre.groupBy(*group).agg(*finals)
    if order is not None:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out


def _mentions(expr: str, column: str) -> bool:
    import re
    return re.search(rf"\b{re.escape(column)}\b", expr, re.I) is not None


def drill_across(parts: list[DataFrame], dims: list[str]) -> DataFrame:
    """SM4: combine per-fact aggregates on shared dimensions without fan-out.

    Each part is already one row per dimension tuple, so the full outer joins
    are between small results. Keys are matched null-safely (the NULL carrier
    group of one fact meets the NULL group of another) and coalesced.
    """
    def combine(a: DataFrame, b: DataFrame) -> DataFrame:
        b2 = b
        for d in dims:
            b2 = b2.withColumnRenamed(d, f"__r_{d}")
        cond = reduce(lambda x, y: x & y, [a[d].eqNullSafe(b2[f"__r_{d}"]) for d in dims])
        j = a.join(b2, cond, "full_outer")
        keep = [F.coalesce(a[d], b2[f"__r_{d}"]).alias(d) for d in dims]
        rest = [c for c in j.columns if c not in dims and not c.startswith("__r_")]
        return j.select(*keep, *[F.col(c) for c in rest])
    return reduce(combine, parts)
