"""Semantic layer: metrics, dimensions, facts and named filters resolved to DataFrames."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.operators import sketches


class SemanticError(ValueError):
    """A request the model does not allow. Raised before any job runs."""


@dataclass(frozen=True)
class Part:
    """One aggregate of a metric.

    sum, count, min and max merge by themselves. key counts distinct keys of the entity: a
    key fixes its foreign keys, so counts per foreign key add up. distinct and median are
    carried to the last step as grouping values, or on request replaced by sketches that
    merge by themselves.
    """

    kind: str
    expr: str


@dataclass(frozen=True)
class Metric:
    name: str
    parts: Mapping[str, Part]
    result: str
    unit: str = ""


@dataclass(frozen=True)
class Entity:
    name: str
    table: str
    key: str
    dimensions: Mapping[str, str]
    facts: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    filters: Mapping[str, str] = field(default_factory=dict)
    private: frozenset = frozenset()
    time: str | None = None
    fixed_size: bool = False
    key_is_unique: bool = True


@dataclass(frozen=True)
class Relationship:
    """Many-to-one key equality."""

    left: str
    right: str
    left_key: str
    right_key: str


@dataclass(frozen=True)
class SemanticModel:
    entities: Mapping[str, Entity]
    relationships: Sequence[Relationship]


Predicate = Callable[[Column], Column]


@dataclass(frozen=True)
class _Rule:
    """A row condition on one entity: SQL text, or a predicate on a dimension."""

    entity: str
    build: Callable[[], Column]


class SemanticLayer:
    def __init__(self, model: SemanticModel, tables: Mapping[str, DataFrame], as_of: str):
        self.model, self.tables, self.as_of = model, tables, as_of

    # -- names ---------------------------------------------------------------

    def _find(self, kind: str, name: str) -> tuple[str, str]:
        """(entity, plain name) of a possibly qualified name."""
        owner, _, plain = name.rpartition(".")
        owners = [e.name for e in self.model.entities.values() if plain in getattr(e, kind) and owner in ("", e.name)]
        if not owners:
            raise SemanticError(f"unknown name in {kind}: {name}")
        if len(owners) > 1:
            raise SemanticError(f"{name} exists on {', '.join(owners)}; qualify it")
        if plain in self.model.entities[owners[0]].private:
            raise SemanticError(f"{name} is private")
        return owners[0], plain

    def _path(self, start: str, goal: str) -> list[Relationship]:
        """Shortest chain of many-to-one edges."""
        paths: dict[str, list[Relationship]] = {start: []}
        queue = [start]
        for here in queue:
            for r in self.model.relationships:
                if r.left == here and r.right not in paths:
                    paths[r.right] = [*paths[here], r]
                    queue.append(r.right)
        if goal not in paths:
            raise SemanticError(f"{goal} cannot be reached from {start}: a row of {start} has many rows there")
        return paths[goal]

    # -- row-level facts -----------------------------------------------------

    def facts(self, facts: Sequence[str], dimensions: Sequence[str] = (), metrics: Sequence[str] = ()) -> DataFrame:
        """Row-level values, not aggregated. All names come from one entity."""
        if metrics:
            raise SemanticError("facts and metrics cannot be in one request")
        named = [("facts", *self._find("facts", n)) for n in facts] + [("dimensions", *self._find("dimensions", n)) for n in dimensions]
        owners = {owner for _, owner, _ in named}
        if len(owners) != 1:
            raise SemanticError("with facts, all dimensions must come from the entity of the facts")
        entity = self.model.entities[owners.pop()]
        return self.tables[entity.table].select(*[F.expr(getattr(entity, kind)[plain]).alias(plain) for kind, _, plain in named])

    # -- metrics ---------------------------------------------------------------

    def query(
        self,
        metrics: Sequence[str],
        dimensions: Sequence[str] = (),
        where: Sequence[tuple[str, Predicate]] = (),
        filters: Sequence[str] = (),
        order: Sequence[tuple[str, str]] = (),
        limit: int | None = None,
        best: bool | None = None,
        defaults: bool = False,
        rounded: bool = False,
        facts: Sequence[str] = (),
        sets: Sequence[Sequence[str]] | None = None,
        approximate: bool = False,
    ) -> DataFrame:
        """Metrics by dimensions.

        Metrics of different facts are aggregated apart and then put side by side, so a
        join never multiplies rows. ``best`` ranks by mean score: low is best.

        ``sets`` names the groupings wanted of the dimensions, ``[]`` being the grand total;
        all come from one pass over the sums below the joins, and ``grouped_by`` tells which
        grouping a row is of. ``approximate`` forms distinct counts and medians by sketches
        (errors in :mod:`clearplate.operators.sketches`), whose size does not grow with the values.
        """
        if facts:
            raise SemanticError("facts and metrics cannot be in one request")
        if not metrics:
            raise SemanticError("a request needs at least one metric")
        dims = [self._find("dimensions", d) for d in dimensions]
        names = [plain for _, plain in dims]
        if len(set(names)) != len(names):
            raise SemanticError("two dimensions share a name")
        for one in sets or ():
            if not set(one) <= set(names):
                raise SemanticError("a grouping names dimensions of the request")
        by_entity: dict[str, list[Metric]] = {}
        for m in metrics:
            owner, plain = self._find("metrics", m)
            by_entity.setdefault(owner, []).append(self.model.entities[owner].metrics[plain])
        applied: list[str] = []
        where = list(where)
        rules = [self._dimension_rule(n, p) for n, p in where] + [self._named_filter(n) for n in filters]
        if defaults and "borough" not in [n.rpartition(".")[2] for n, _ in where]:
            rules.append(self._dimension_rule("borough", lambda c: c != "0"))
            applied.append("borough != '0' — records with missing borough data are left out")
        dated = any(self._is_date(n) for n, _ in where) or any(n.rpartition(".")[2].startswith("recent") for n in filters)
        recent = defaults and not dated and any(self.model.entities[e].time for e in by_entity)
        if recent:
            applied.append(f"inspection_date between add_months(date'{self.as_of}', -12) and date'{self.as_of}' — last 12 months, as no date was given")

        results = []
        for owner, wanted in by_entity.items():
            own = list(rules)
            time = self.model.entities[owner].time
            if recent and time:
                own.append(_Rule(owner, lambda t=time: F.expr(f"{t} between add_months(date'{self.as_of}', -12) and date'{self.as_of}'")))
            results += [self._aggregate(self.model.entities[owner], batch, dims, own, rounded, sets, approximate) for batch in _batches(wanted)]
        out = results[0]
        if len(results) > 1:
            # Drill-across: one row per group from each fact, laid over each other. Grouping
            # treats NULL groups as equal, so no null-safe outer join is needed.
            for r in results[1:]:
                out = out.unionByName(r, allowMissingColumns=True)
            measured = [m.name for ms in by_entity.values() for m in ms]
            out = out.groupBy(*names, *(["grouped_by"] if sets is not None else [])).agg(*[F.max(m).alias(m) for m in measured])
        if defaults:
            out = out.withColumn("applied_filters", F.array(*map(F.lit, applied)).cast("array<string>"))
        if best is not None:
            order = [("average_score", "asc" if best else "desc"), *order]
        if order:
            out = out.orderBy(*[F.col(n).desc_nulls_last() if way == "desc" else F.col(n).asc_nulls_last() for n, way in order])
        return out if limit is None else out.limit(limit)

    def freshness(self, entity: str = "inspections") -> Column:
        """Latest date in a fact, as a scalar to put beside any answer."""
        e = self.model.entities[entity]
        return self.tables[e.table].agg(F.max(F.expr(e.time)).alias("d")).scalar()

    def _is_date(self, name: str) -> bool:
        owner, plain = self._find("dimensions", name)
        return owner == "dates" or plain == self.model.entities[owner].time

    def _dimension_rule(self, name: str, predicate: Predicate) -> _Rule:
        owner, plain = self._find("dimensions", name)
        expr = self.model.entities[owner].dimensions[plain]
        return _Rule(owner, lambda: predicate(F.expr(expr)))

    def _named_filter(self, name: str) -> _Rule:
        owner, plain = self._find("filters", name)
        text = self.model.entities[owner].filters[plain].replace("{as_of}", f"date'{self.as_of}'")
        return _Rule(owner, lambda: F.expr(text))

    def _aggregate(self, entity: Entity, metrics: list[Metric], dims, rules: list[_Rule], rounded: bool, sets: Sequence[Sequence[str]] | None = None, approximate: bool = False) -> DataFrame:
        """Metrics of one entity by dimensions.

        Sums are formed at the grain (foreign keys, own dimensions) before a growing
        table is joined: a hot key is one row by then, and the join moves groups, not rows.
        """
        needed = dict.fromkeys([o for o, _ in dims] + [r.entity for r in rules])
        needed.pop(entity.name, None)
        edges = list(dict.fromkeys(e for target in needed for e in self._path(entity.name, target)))
        parts = {f"{m.name}__{p}": part for m in metrics for p, part in m.parts.items()}
        if approximate:
            parts = {a: Part({"distinct": "hll", "median": "kll"}.get(p.kind, p.kind), p.expr) for a, p in parts.items()}
        carried = {a: p for a, p in parts.items() if p.kind in ("distinct", "median")}

        base = self.tables[entity.table]
        for rule in (r for r in rules if r.entity == entity.name):
            base = base.filter(rule.build())
        first_hop = [e for e in edges if e.left == entity.name]
        base = base.select(
            *[F.expr(e.left_key).alias(f"_fk_{e.right}") for e in first_hop],
            *[F.expr(entity.dimensions[d]).alias(f"_d_{d}") for o, d in dims if o == entity.name],
            *[F.expr(p.expr).alias(a) for a, p in parts.items()],
        )
        for e in (e for e in first_hop if self.model.entities[e.right].fixed_size):
            base = self._attach(base, e, dims, rules, edges)
        growing = [e for e in edges if not (e in first_hop and self.model.entities[e.right].fixed_size)]
        if growing:
            keep = [c for c in base.columns if c not in parts] + list(carried)
            sums = [_first_step(p.kind, a) for a, p in parts.items() if a not in carried]
            base = base.groupBy(*keep).agg(*sums, F.count(F.lit(1)).alias("_rows"))
            merge = _merge
        else:
            base = base.withColumn("_rows", F.lit(1))
            merge = _first_step
        for e in growing:
            base = self._attach(base, e, dims, rules, edges)
        groups = [f"_d_{d}" for _, d in dims]
        values = [_carried(p.kind, a) if a in carried else merge(p.kind, a) for a, p in parts.items()]
        if sets is None:
            totals = base.groupBy(*groups).agg(*values)
        else:
            named = F.concat_ws(",", *[F.when(F.grouping(g) == 0, d) for g, (_, d) in zip(groups, dims)])
            totals = base.groupingSets([[F.col(f"_d_{d}") for d in one] for one in sets], *map(F.col, groups)).agg(*values, named.alias("grouped_by"))
        totals = totals.withColumns({a: sketches.estimate(p.kind, a) for a, p in parts.items() if p.kind in ("hll", "kll")})
        shown = [F.col(f"_d_{d}").alias(d) for _, d in dims] + ([] if sets is None else [F.col("grouped_by")])
        return totals.select(*shown, *[_result(m, rounded).alias(m.name) for m in metrics])

    def _attach(self, df: DataFrame, edge: Relationship, dims, rules, edges) -> DataFrame:
        """Inner join along one edge, carrying only the columns asked for."""
        entity = self.model.entities[edge.right]
        right = self.tables[entity.table]
        if not entity.key_is_unique:
            # Declared many-to-one, but the data may hold two rows per key: keep one, or rows would multiply.
            right = self._one_per_key(right, edge, [entity.dimensions[d] for o, d in dims if o == entity.name], [e.left_key for e in edges if e.left == edge.right], any(r.entity == entity.name for r in rules))
        for rule in (r for r in rules if r.entity == entity.name):
            right = right.filter(rule.build())
        right = right.select(
            F.expr(edge.right_key).alias("_pk"),
            *[F.expr(entity.dimensions[d]).alias(f"_d_{d}") for o, d in dims if o == entity.name],
            *[F.expr(e.left_key).alias(f"_fk_{e.right}") for e in edges if e.left == edge.right],
        )
        if entity.fixed_size:
            right = F.broadcast(right)
        return df.join(right, df[f"_fk_{edge.right}"] == right["_pk"]).drop("_pk", f"_fk_{edge.right}")


    @staticmethod
    def _one_per_key(right: DataFrame, edge: Relationship, dimensions: Sequence[str], keys: Sequence[str], ruled: bool) -> DataFrame:
        """Least row per key over the columns asked for, nulls last: one aggregate, cut to a row per key on each task.

        A rule may read any column, so with rules all columns take part.
        """
        columns = [c for c in right.columns if c != edge.right_key]
        if not ruled:
            wanted = " ".join([*dimensions, *keys])
            columns = [c for c in columns if re.search(rf"\b{re.escape(c)}\b", wanted)]
        if not columns:
            return right.select(edge.right_key).distinct()
        least = F.min(F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))]))
        return right.groupBy(edge.right_key).agg(least.alias("_least")).select(edge.right_key, *[F.col(f"_least.{c}").alias(c) for c in columns])


def _batches(metrics: list[Metric]) -> list[list[Metric]]:
    """Metrics that can share one aggregation. Values carried as groups would split a key, so keys are counted apart from them."""
    by_key = [m for m in metrics if any(p.kind == "key" for p in m.parts.values())]
    carry = any(p.kind in ("distinct", "median") for m in metrics for p in m.parts.values())
    if not (by_key and carry):
        return [metrics]
    return [by_key, [m for m in metrics if m not in by_key]]


def _first_step(kind: str, alias: str) -> Column:
    own = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "key": F.count_distinct, "hll": sketches.distinct_sketch, "kll": sketches.quantile_sketch}
    return own[kind](alias).alias(alias)


def _merge(kind: str, alias: str) -> Column:
    own = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "key": F.sum, "hll": sketches.merge_distinct, "kll": sketches.merge_quantile}
    return own[kind](alias).alias(alias)


def _carried(kind: str, alias: str) -> Column:
    if kind == "distinct":
        return F.count_distinct(alias).alias(alias)
    return F.percentile(alias, F.lit(0.5), F.col("_rows")).alias(alias)


def _result(metric: Metric, rounded: bool) -> Column:
    text = metric.result
    for part in sorted(metric.parts, key=len, reverse=True):
        text = text.replace("{" + part + "}", f"`{metric.name}__{part}`")
    value = F.expr(text)
    if rounded and metric.unit:
        value = F.round(value, 1 if metric.unit == "percent" else 0)
    return value
