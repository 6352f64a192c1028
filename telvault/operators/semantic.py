"""A small metric layer: semantic models bound to DataFrames.

Measures aggregate a column (sum / avg / min / max / count); a measure
with ``create_metric`` is also a metric; simple metrics may carry a SQL
filter that is applied inside the aggregate (``sum(CASE WHEN f THEN m)``),
so several metrics with different filters share one ``groupBy`` pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.functions.scoring import exact_avg

_AGG = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


@dataclass(frozen=True)
class Entity:
    name: str
    type: str  # primary | unique | foreign


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    create_metric: bool = False


@dataclass(frozen=True)
class Dimension:
    name: str
    type: str = "categorical"       # categorical | time
    granularity: str | None = None  # for time dimensions


@dataclass(frozen=True)
class Metric:
    name: str
    measure: str
    filter: str | None = None
    type: str = "simple"


@dataclass(frozen=True)
class SemanticModel:
    name: str
    entities: tuple[Entity, ...] = ()
    measures: tuple[Measure, ...] = ()
    dimensions: tuple[Dimension, ...] = ()
    metrics: tuple[Metric, ...] = ()
    default_time_dimension: str | None = None

    def all_metrics(self) -> dict[str, Metric]:
        out = {m.name.lower(): Metric(m.name.lower(), m.name) for m in self.measures if m.create_metric}
        out.update({m.name: m for m in self.metrics})
        return out

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name.lower() == name.lower():
                return m
        raise KeyError(f"{self.name}: no measure {name}")

    def dimension(self, name: str) -> Dimension:
        for d in self.dimensions:
            if d.name.lower() == name.lower():
                return d
        raise KeyError(f"{self.name}: no dimension {name}")

    def groupable(self, name: str) -> bool:
        """Dimensions and entities can both be grouped by."""
        return any(x.name.lower() == name.lower() for x in (*self.dimensions, *self.entities))

    def validate(self, df: DataFrame, names=None) -> None:
        """The bound frame must carry the named columns (default: every model column)."""
        names = list(names) if names is not None else [x.name for x in (*self.entities, *self.measures,
                                                                         *self.dimensions)]
        have = {c.lower() for c in df.columns}
        missing = [n for n in names if n.lower() not in have]
        if missing:
            raise KeyError(f"{self.name}: frame lacks {missing}")


def metric_column(model: SemanticModel, metric: Metric, round_digits: int | None = None) -> Column:
    meas = model.measure(metric.measure)
    value = F.col(meas.name)
    if metric.filter:
        value = F.when(F.expr(metric.filter), value)
    if round_digits is not None and meas.agg == "avg":
        return exact_avg(value, round_digits).alias(metric.name)
    agg = _AGG[meas.agg](value)
    if round_digits is not None:
        agg = F.round(agg, round_digits)
    return agg.alias(metric.name)


def metric_query(model: SemanticModel, df: DataFrame, metrics: list[str], group_by: list[str] = (),
                 grain: str | None = None, round_digits: int | None = None) -> DataFrame:
    """Metrics by dimensions; ``grain`` truncates the model's default time dimension.

    The time bucket column is named ``<dimension>__<grain>`` (lower case).
    """
    defined = model.all_metrics()
    unknown = [m for m in metrics if m not in defined]
    if unknown:
        raise KeyError(f"{model.name}: unknown metrics {unknown}")
    model.validate(df, [defined[m].measure for m in metrics] + list(group_by)
                   + ([model.default_time_dimension] if grain else []))
    keys = []
    for g in group_by:
        if not model.groupable(g):
            raise KeyError(f"{model.name}: {g} is neither a dimension nor an entity")
        keys.append(F.col(g).alias(g.lower()))
    if grain:
        td = model.default_time_dimension
        bucket = F.date_trunc(grain, F.col(td))
        ftype = next(f.dataType for f in df.schema.fields if f.name.lower() == td.lower())
        if isinstance(ftype, T.TimestampNTZType):
            bucket = bucket.cast("timestamp_ntz")   # date_trunc yields a zoned timestamp; keep wall-clock type
        keys.append(bucket.alias(f"{td.lower()}__{grain}"))
    return df.groupBy(*keys).agg(*[metric_column(model, defined[m], round_digits) for m in metrics])


class AmbiguousPathError(ValueError):
    pass


def _paths(models: dict[str, SemanticModel], start: str, wanted: str) -> list[list[tuple[str, str]]]:
    """Shortest ways from ``start`` to a model that has ``wanted``: steps (entity, model). A step goes over an entity that
    both have and that is primary or unique in the model it leads to, so it finds one row there."""
    level, seen = [(start, [])], {start}
    while level:
        found = [path for at, path in level if models[at].groupable(wanted) and path]
        if found:
            return found
        further = []
        for at, path in level:
            for name, model in models.items():
                if name not in seen:
                    own = {e.name for e in models[at].entities}
                    further += [(name, [*path, (e.name, name)]) for e in model.entities if e.name in own and e.type in ("primary", "unique")]
        seen |= {name for name, _ in further}
        level = further
    return []


def metric_query_across(bound: dict[str, tuple[SemanticModel, DataFrame]], metrics: list[str], group_by: list[str],
                        via: dict[str, str] | None = None, round_digits: int | None = None) -> DataFrame:
    """Metrics of several models by common dimensions or entities.

    ``bound`` names the models and their frames; a metric is ``name`` or ``model.name``. Each model's metrics are
    aggregated to ``group_by`` before anything is joined, so rows of one model cannot multiply the sums of another. A
    dimension that a model lacks is looked up over shared entities (``_paths``); the looked-up side is brought to one row per
    entity first (of several values the least counts), so the lookup cannot multiply rows either. Several shortest paths
    are an error, unless ``via`` names the entity to go over for the dimension.
    """
    models = {name: model for name, (model, _) in bound.items()}
    chosen: dict[str, list[str]] = {}
    for m in metrics:
        owner, _, metric = m.rpartition(".")
        owners = [owner] if owner else [n for n, model in models.items() if metric in model.all_metrics()]
        if len(owners) != 1 or owners[0] not in models:
            raise KeyError(f"{m}: a metric of {len(owners)} of the models" if not owner else f"{owner}: no such model")
        chosen.setdefault(owners[0], []).append(metric)
    out = None
    for name, names in chosen.items():
        model, df = bound[name]
        defined = model.all_metrics()
        unknown = [x for x in names if x not in defined]
        if unknown:
            raise KeyError(f"{model.name}: unknown metrics {unknown}")
        keys = []
        for k, g in enumerate(group_by):
            if model.groupable(g):
                keys.append(F.col(g).alias(g.lower()))
                continue
            paths = _paths(models, name, g)
            if via and g in via:
                paths = [p for p in paths if p[0][0] == via[g]]
            if len(paths) != 1:
                raise AmbiguousPathError(f"{name}: {len(paths)} paths to {g}: " + "; ".join(" > ".join(f"{e} of {n}" for e, n in p) for p in paths))
            # from the far end back: one row per entity with the value that is looked up
            far, value = None, g
            for entity, at in reversed(paths[0]):
                frame = bound[at][1] if far is None else bound[at][1].join(far, F.col(value_key).eqNullSafe(F.col("__key")), "left").drop("__key")
                value_key, one = entity, F.min(F.col(g if far is None else "__value")).alias("__value")
                far = frame.where(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("__key")).agg(one)
            df = df.join(far.withColumnRenamed("__key", f"__key{k}").withColumnRenamed("__value", f"__value{k}"),
                         F.col(value_key) == F.col(f"__key{k}"), "left").drop(f"__key{k}")
            keys.append(F.col(f"__value{k}").alias(g.lower()))
        part = df.groupBy(*keys).agg(*[metric_column(model, defined[x], round_digits) for x in names])
        if out is None:
            out = part
        else:
            same = [F.col(f"l.{g.lower()}").eqNullSafe(F.col(f"r.{g.lower()}")) for g in group_by]
            both = out.alias("l").join(part.alias("r"), same, "full")
            out = both.select(*[F.coalesce(F.col(f"l.{g.lower()}"), F.col(f"r.{g.lower()}")).alias(g.lower()) for g in group_by],
                              *[f"l.{c}" for c in out.columns if c not in {g.lower() for g in group_by}], *[f"r.{x}" for x in names])
    return out


# --- fixed values: semantic models of the silver and gold products -------------
CORE_MODEL = SemanticModel(
    "subscriber360_core_semantic_model",
    entities=(Entity("ACCOUNT_ID", "primary"), Entity("SERVICE_ID", "unique"), Entity("SUBSCRIPTION_ID", "foreign")),
    measures=(Measure("MONTHLY_RECURRING_CHARGE", "sum", True), Measure("DATA_MB_30D", "sum", True),
              Measure("SUPPORT_HEALTH_SCORE", "avg")),
    dimensions=(Dimension("SERVICE_STATUS"), Dimension("BILLING_STATUS"), Dimension("SUPPORT_RISK_BAND"),
                Dimension("SNAPSHOT_AT", "time", "day")),
    metrics=(Metric("active_recurring_revenue", "MONTHLY_RECURRING_CHARGE", "SERVICE_STATUS = 'active'"),
             Metric("avg_support_health_score", "SUPPORT_HEALTH_SCORE")),
    default_time_dimension="SNAPSHOT_AT",
)
SCORECARD_MODEL = SemanticModel(
    "subscriber_health_scorecard_semantic_model",
    entities=(Entity("ACCOUNT_ID", "primary"), Entity("SERVICE_ID", "unique")),
    measures=(Measure("OPEN_TICKET_COUNT_30D", "sum", True), Measure("INTERACTION_COUNT_30D", "sum", True),
              Measure("SUPPORT_HEALTH_SCORE", "avg", True)),
    dimensions=(Dimension("SUPPORT_RISK_BAND"), Dimension("SNAPSHOT_AT", "time", "day")),
    metrics=(Metric("average_support_health", "SUPPORT_HEALTH_SCORE"),
             Metric("open_ticket_pressure", "OPEN_TICKET_COUNT_30D")),
    default_time_dimension="SNAPSHOT_AT",
)
CUSTOMER_360_MODEL = SemanticModel(
    "customer_360_cdp_semantic_model",
    entities=(Entity("ACCOUNT_ID", "primary"),),
    measures=(Measure("SUBSCRIPTION_COUNT", "sum", True), Measure("TOTAL_REVENUE_30D", "sum", True),
              Measure("AVG_HEALTH_SCORE", "avg", True)),
    dimensions=(Dimension("SNAPSHOT_AT", "time", "day"),),
    default_time_dimension="SNAPSHOT_AT",
)
