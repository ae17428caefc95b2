"""The declared semantic model: logical tables, metrics, named filters and relationships."""

from __future__ import annotations

from clearplate.operators.semantic import Entity, Metric, Part, Relationship, SemanticLayer, SemanticModel
from clearplate.plans.build import Marts


def _same(*names: str, **renamed: str) -> dict[str, str]:
    return {**{n: n for n in names}, **renamed}


def _metrics(*ms: Metric) -> dict[str, Metric]:
    return {m.name: m for m in ms}


def _total(name: str, expr: str) -> Metric:
    return Metric(name, {"s": Part("sum", expr)}, "{s}")


def _mean(name: str, expr: str, unit: str = "") -> Metric:
    return Metric(name, {"s": Part("sum", expr), "n": Part("count", expr)}, "{s} * 1d / nullif({n}, 0)", unit)


def _share(name: str, condition: str, of: str) -> Metric:
    """Percentage of counted rows that meet a condition; an unknown condition counts as not met."""
    parts = {"hit": Part("sum", f"if({condition}, 1, 0)"), "n": Part("count", of)}
    return Metric(name, parts, "{hit} * 100d / nullif({n}, 0)", "percent")


# Names, conditions and text patterns that callers of the model rely on.
RESTAURANTS = Entity(
    "restaurants", "dim_restaurant", "dim_restaurant_key",
    dimensions=_same(
        "dim_restaurant_key", "restaurant_id", "restaurant_name", "borough", "zipcode", "street_address",
        "neighborhood_code", "phone", cuisine_type="cuisine_description",
    ),
    facts=_same("latitude", "longitude"),
    metrics=_metrics(Metric("total_restaurants", {"ids": Part("distinct", "restaurant_id")}, "{ids}")),
)
VIOLATION_TYPES = Entity(
    "violation_types", "dim_violation_type", "dim_violation_key",
    dimensions=_same(
        "dim_violation_key", "violation_code", "violation_description", "criticality_label", is_critical="is_critical_violation",
    ),
)
DATES = Entity(
    "dates", "dim_date", "date_key",
    dimensions=_same(
        "calendar_date", "date_key", "year_number", "quarter_label", "month_name", "month_number", "day_of_week",
        "is_weekend", "year_month", "year_quarter", day_name="day_name_short",
    ),
    time="calendar_date",
    fixed_size=True,
)
INSPECTIONS = Entity(
    "inspections", "fct_inspections", "fct_inspection_key",
    dimensions=_same(
        "fct_inspection_key", "dim_restaurant_key", "inspection_date_key", "inspection_type", "action", "grade",
        "inspection_date", "grade_date", "passed_with_grade_a", "has_critical_violation",
    ),
    facts=_same("inspection_score", "total_violations", "critical_violations", "non_critical_violations", "grade_sort_order"),
    metrics=_metrics(
        Metric("total_inspections", {"n": Part("count", "fct_inspection_key")}, "{n}"),
        _mean("average_score", "inspection_score", "score"),
        Metric("median_score", {"v": Part("median", "inspection_score")}, "{v}", "score"),
        Metric("max_score", {"v": Part("max", "inspection_score")}, "{v}", "score"),
        _total("total_violations_cited", "total_violations"),
        _total("total_critical_violations_cited", "critical_violations"),
        _share("grade_a_pass_rate", "passed_with_grade_a", "1"),
        _share("grade_b_rate", "grade = 'B'", "fct_inspection_key"),
        _share("grade_c_rate", "grade = 'C'", "fct_inspection_key"),
        _share("closure_rate", "action ilike '%Establishment Closed%'", "fct_inspection_key"),
        _share("re_inspection_rate", "inspection_type ilike '%Re-Inspection%'", "fct_inspection_key"),
        Metric(
            "inspections_with_critical_pct",
            {
                "hit": Part("key", "if(has_critical_violation, fct_inspection_key, null)"),
                "all": Part("key", "fct_inspection_key"),
            },
            "{hit} * 100d / nullif({all}, 0)", "percent",
        ),
        _mean("avg_violations_per_inspection", "total_violations"),
        _mean("avg_critical_violations_per_inspection", "critical_violations"),
    ),
    filters={
        "graded_inspections": "grade in ('A', 'B', 'C')",
        "initial_inspections": "inspection_type ilike '%Initial Inspection%'",
        "re_inspections": "inspection_type ilike '%Re-Inspection%'",
        "closures": "action ilike '%Establishment Closed%'",
        "clean_inspections": "action ilike '%No violations were recorded%'",
        "recent_12_months": "inspection_date between add_months({as_of}, -12) and {as_of}",
        "recent_6_months": "inspection_date between add_months({as_of}, -6) and {as_of}",
    },
    private=frozenset({"grade_sort_order"}),
    time="inspection_date",
    key_is_unique=False,
)
VIOLATIONS = Entity(
    "violations", "fct_violations", "fct_violation_key",
    dimensions=_same(
        "fct_violation_key", "dim_restaurant_key", "dim_violation_key", "inspection_date_key", "fct_inspection_key",
        "violation_code", "is_critical_violation", "inspection_type", "action", "inspection_date",
    ),
    facts=_same("violation_count", "inspection_score"),
    metrics=_metrics(
        _total("total_violation_citations", "violation_count"),
        Metric(
            "critical_violation_rate",
            {"hit": Part("sum", "if(is_critical_violation, violation_count, 0)"), "n": Part("sum", "violation_count")},
            "{hit} * 100d / nullif({n}, 0)", "percent",
        ),
        _total("critical_violation_citations", "if(is_critical_violation, violation_count, 0)"),
        _total("non_critical_violation_citations", "if(not is_critical_violation, violation_count, 0)"),
        Metric("distinct_violation_codes_cited", {"codes": Part("distinct", "violation_code")}, "{codes}"),
    ),
    filters={
        "critical_only": "is_critical_violation = true",
        "non_critical_only": "is_critical_violation = false",
        "recent_12_months": "inspection_date between add_months({as_of}, -12) and {as_of}",
        "recent_6_months": "inspection_date between add_months({as_of}, -6) and {as_of}",
    },
    private=frozenset({"inspection_score"}),
    time="inspection_date",
)

MODEL = SemanticModel(
    {e.name: e for e in (RESTAURANTS, VIOLATION_TYPES, DATES, INSPECTIONS, VIOLATIONS)},
    [
        Relationship("inspections", "restaurants", "dim_restaurant_key", "dim_restaurant_key"),
        Relationship("inspections", "dates", "inspection_date_key", "date_key"),
        Relationship("violations", "violation_types", "dim_violation_key", "dim_violation_key"),
        Relationship("violations", "dates", "inspection_date_key", "date_key"),
        Relationship("violations", "inspections", "fct_inspection_key", "fct_inspection_key"),
        Relationship("violations", "restaurants", "dim_restaurant_key", "dim_restaurant_key"),
    ],
)


def semantic_layer(marts: Marts, as_of: str) -> SemanticLayer:
    return SemanticLayer(MODEL, {n: getattr(marts, n) for n in marts.__dataclass_fields__}, as_of)
