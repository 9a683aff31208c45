"""Reconcile several feeds into one current row per key.

All sources are aligned to one event schema, tagged, unioned and reduced by a
single ``groupBy(keys)``:

* the winner is ``max_by(row, (class, event_date, priority, tiebreak))`` --
  newest event first, a higher-priority source wins a date tie, and *fallback*
  sources (class 0, e.g. enrollments) win only when the key has no primary
  record at all (gap fill without an anti join);
* ``last_seen`` = newest event among *snapshot* rows (absence delete), compared
  with the newest snapshot overall, a scalar subquery; with several snapshot
  feeds a key is absent when every feed that ever listed it has since left it out;
* the newest *change* row gives the explicit delete flag (flag delete).

One shuffle on the key replaces a chain of windows and joins, and the partial
aggregate collapses hot keys before the exchange.  Expressions are handed to
Spark as SQL text (one JVM call per projection) -- the plan is the same as
with Column objects, the driver just builds it faster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPSHOT = "snapshot"
CHANGE = "change"

Expr = str | Column   # a SQL expression (a bare column name is one) or a Column


@dataclass
class SourceSpec:
    """One input feed.

    columns   target column -> source column name / SQL expression / Column;
              target columns absent here are NULL (typed by ``types``)
    tag       value of the provenance column for rows of this feed
    priority  precedence on an event-date tie (higher wins)
    fallback  gap-fill source: used only for keys no primary feed has
    tiebreak  total order inside the feed (greatest wins), e.g. a record id
    role      ``snapshot`` (absence means deleted), ``change`` (carries a
              delete flag) or None
    """

    df: DataFrame
    columns: Mapping[str, Expr]
    tag: str
    priority: int = 0
    fallback: bool = False
    tiebreak: Sequence[Expr] = ()
    role: str | None = None
    snapshot_date: Expr | None = None   # for role=snapshot: the delivery date
    # for role=snapshot: frame the newest snapshot date is taken from; pass the
    # raw feed when ``df`` is a deduplicated view of it (dedup never removes a
    # whole delivery), so the scalar subquery is a pruned scan, not a re-shuffle
    snapshot_dates: DataFrame | None = None


@dataclass
class ReconcileConfig:
    keys: Sequence[str]
    event_col: str = "event_date"
    source_col: str = "record_source"
    flag_col: str = "soft_delete_flag"
    flag_value: str = "Y"
    types: Mapping[str, str] = field(default_factory=dict)


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def align(spec: SourceSpec, target: Sequence[str], cfg: ReconcileConfig,
          width: int | None = None, feed: int = 0) -> DataFrame:
    """Project one feed onto the common event schema plus ordering columns.

    ``width`` is the number of tiebreak fields of the feed that has most (shorter
    lists are padded with NULL); ``feed`` numbers the snapshot feeds."""
    df = spec.df
    width = len(spec.tiebreak) if width is None else width
    staged: dict[str, str] = {}
    # Column-valued specs are materialised first (slower path, same plan)
    col_specs = {k: v for k, v in spec.columns.items() if isinstance(v, Column)}
    tb = list(spec.tiebreak)
    for i, t in enumerate(tb):
        if isinstance(t, Column):
            col_specs[f"__tbsrc{i}"] = t
    if col_specs:
        df = df.select("*", *[c.alias(f"__src_{k}") for k, c in col_specs.items()])
        staged = {k: _q(f"__src_{k}") for k in col_specs}

    def src(name: str, value) -> str:
        return staged[name] if name in staged else str(value)

    exprs = []
    for name in target:
        typ = cfg.types.get(name, "string")
        if name == cfg.source_col:
            exprs.append(f"{_lit(spec.tag)} AS {_q(name)}")
        elif name in spec.columns:
            exprs.append(f"CAST({src(name, spec.columns[name])} AS {typ}) AS {_q(name)}")
        else:
            exprs.append(f"CAST(NULL AS {typ}) AS {_q(name)}")
    tb_exprs = [src(f"__tbsrc{i}", t) for i, t in enumerate(tb)]
    tb_exprs += ["NULL"] * (max(width, 1) - len(tb_exprs))
    exprs += [
        f"{0 if spec.fallback else 1} AS __class",
        f"{int(spec.priority)} AS __prio",
        "named_struct(" + ", ".join(f"'t{i}', CAST({t} AS STRING)" for i, t in enumerate(tb_exprs))
        + ") AS __tb",
        f"CAST({_lit(spec.role)} AS STRING) AS __role",
        f"{int(feed)} AS __feed",
    ]
    return df.selectExpr(*exprs)


def _seen(feed: int) -> str:
    """Column of the newest date in snapshot feed number ``feed``."""
    return "__seen" if feed == 0 else f"__seen{feed}"


CANDIDATE_COLUMNS = ["__apart", "__cand", "__ord", "__seen", "__chg", "__chg_ord"]


def tiebreak_width(sources: Sequence[SourceSpec]) -> int:
    """Fields of the longest tiebreak list."""
    return max((len(s.tiebreak) for s in sources), default=0)


def _snapshots(sources: Sequence[SourceSpec]) -> list[SourceSpec]:
    return [s for s in sources if s.role == SNAPSHOT]


def candidates(sources: Sequence[SourceSpec], cfg: ReconcileConfig,
               target: Sequence[str], width: int | None = None) -> DataFrame:
    """Aligned rows of every feed as reduction candidates: keys, the row
    (``__cand``) and its precedence (``__ord``), the snapshot date it proves
    (``__seen``) and, for change rows, the flag candidate (``__chg``,
    ``__chg_ord``).  Reducing candidates is associative, so candidates of new
    deliveries can be folded into an earlier reduction (see
    :func:`reduce_candidates`); reductions that are folded together need the same
    ``width`` of tiebreak fields (default: the longest list given)."""
    keys = list(cfg.keys)
    ev = _q(cfg.event_col)
    width = tiebreak_width(sources) if width is None else width
    numbers = {id(s): i for i, s in enumerate(_snapshots(sources))}
    aligned = [align(s, target, cfg, width, numbers.get(id(s), 0)) for s in sources]
    events = aligned[0]
    for a in aligned[1:]:
        events = events.unionByName(a)
    # NULL keys never match in an equi-join: a fallback row with an incomplete
    # key is kept apart from the primary rows of the same (NULL) key.
    incomplete = " OR ".join(f"{_q(k)} IS NULL" for k in keys)
    chg = "__role = 'change'"
    flag = _q(cfg.flag_col) if cfg.flag_col in target else "CAST(NULL AS STRING)"
    if len(numbers) > 1:
        seen = [f"CASE WHEN __role = 'snapshot' AND __feed = {i} THEN {ev} END AS {_seen(i)}"
                for i in range(len(numbers))]
    else:
        seen = [f"CASE WHEN __role = 'snapshot' THEN {ev} END AS __seen"]
    return events.selectExpr(
        *[_q(k) for k in keys],
        f"(({incomplete}) AND __class = 0) AS __apart",
        "struct(" + ", ".join(_q(c) for c in target) + ") AS __cand",
        f"struct(__class, {ev}, __prio, __tb) AS __ord",
        *seen,
        f"CASE WHEN {chg} THEN named_struct('flag', {flag}, 'at', {ev}) END AS __chg",
        f"CASE WHEN {chg} THEN struct({ev}, __tb) END AS __chg_ord",
        *[_q(c) for c in target],
    )


def reduce_candidates(cands: DataFrame, cfg: ReconcileConfig,
                      extra: Mapping[str, Expr] | None = None) -> DataFrame:
    """One row per key (and ``__apart``): the best candidate, newest snapshot
    date and best change flag, as one partial + final aggregate."""
    extra = dict(extra or {})
    aggs = [
        F.expr("max_by(__cand, __ord)").alias("__cand"),
        F.expr("max(__ord)").alias("__ord"),
        *[F.expr(f"max({c})").alias(c) for c in cands.columns if c.startswith("__seen")],
        F.expr("max_by(__chg, __chg_ord)").alias("__chg"),
        F.expr("max(__chg_ord)").alias("__chg_ord"),
    ]
    aggs += [(F.expr(a) if isinstance(a, str) else a).alias(n) for n, a in extra.items()]
    return cands.groupBy(*cfg.keys, "__apart").agg(*aggs)


def finish(reduced: DataFrame, cfg: ReconcileConfig, target: Sequence[str],
           latest: Column | Sequence[Column] | None,
           snapshot_tag: str | Sequence[str] | None, extra_names: Sequence[str] = ()) -> DataFrame:
    """Winner columns plus raw delete inputs, from a reduction.

    ``latest`` holds the newest date of each snapshot feed, in order."""
    complete = " AND ".join(f"__cand.{_q(k)} IS NOT NULL" for k in cfg.keys)
    flag = _lit(cfg.flag_value)
    latest = [latest] if isinstance(latest, Column) else list(latest or [])
    tags = [snapshot_tag] if isinstance(snapshot_tag, str) else list(snapshot_tag or [])
    seen = [F.col(_seen(i)) for i in range(len(latest))]
    if seen:    # listed somewhere, and in no feed's newest snapshot
        gone = F.coalesce(*seen).isNotNull()
        for s, newest in zip(seen, latest):
            gone = gone & (F.coalesce(s < newest, F.lit(True)))
        gone = F.when(F.coalesce(*seen).isNotNull(), gone)
    last_seen = seen[0] if len(seen) == 1 else F.greatest(*seen) if seen else F.col("__seen")
    out = reduced.select(
        *[F.col(f"__cand.{_q(c)}").alias(c) for c in target],
        last_seen.alias("last_seen_date"),
        ((F.expr(complete) & gone) if seen else F.lit(None).cast("boolean")).alias("is_hard_deleted"),
        F.expr(f"({complete}) AND __chg.flag = {flag}").alias("is_soft_deleted"),
        F.col("__chg.at").alias("soft_deleted_at"),
        F.expr("CAST(array(" + ", ".join(map(_lit, tags)) + ") AS ARRAY<STRING>)").alias("__snapshot_tags"),
        *[F.col(n) for n in extra_names],
    )
    cols = [_q(c) for c in out.columns]
    cols.insert(cols.index("`is_soft_deleted`"),
                "CASE WHEN is_hard_deleted THEN last_seen_date END AS hard_deleted_at")
    return out.selectExpr(*cols)


def reconcile(sources: Sequence[SourceSpec], cfg: ReconcileConfig,
              target: Sequence[str], extra: Mapping[str, Expr] | None = None) -> DataFrame:
    """Current state per key.  Output: the ``target`` columns of the winning
    row plus ``last_seen_date``, ``is_hard_deleted``, ``hard_deleted_at``,
    ``is_soft_deleted``, ``soft_deleted_at`` (before precedence) and a
    ``__snapshot_tags`` helper, all resolved by :func:`delete_status`.

    ``extra`` maps output names to further aggregate expressions over the
    aligned event columns (e.g. history summaries); they ride on the same
    single shuffle."""
    extra = dict(extra or {})
    latest = []
    for snap in _snapshots(sources):
        date_expr = snap.snapshot_date if snap.snapshot_date is not None else snap.columns[cfg.event_col]
        dates = snap.snapshot_dates if snap.snapshot_dates is not None else snap.df
        agg = F.max(date_expr) if isinstance(date_expr, Column) else F.expr(f"max({date_expr})")
        latest.append(dates.agg(agg).scalar())
    reduced = reduce_candidates(candidates(sources, cfg, target), cfg, extra)
    return finish(reduced, cfg, target, latest, [s.tag for s in _snapshots(sources)], list(extra))


def delete_status(df: DataFrame, event_col: str = "event_date",
                  source_col: str = "record_source",
                  hard_label: str = "hard_delete", soft_label: str = "soft_delete") -> DataFrame:
    """Unified delete status.

    A flag delete is overridden when the winning record is a snapshot row
    strictly newer than the flag (re-added).  Absence beats flag for both the
    label and the date.  Adds ``is_deleted``, ``delete_type``, ``deleted_at``.
    """
    soft = (f"(CASE WHEN is_soft_deleted AND array_contains(__snapshot_tags, {_q(source_col)}) "
            f"AND {_q(event_col)} > soft_deleted_at THEN false "
            f"ELSE COALESCE(is_soft_deleted, false) END)")
    return df.selectExpr(
        "*",
        f"COALESCE(is_hard_deleted, false) OR {soft} AS is_deleted",
        f"CASE WHEN is_hard_deleted THEN {_lit(hard_label)} WHEN {soft} THEN {_lit(soft_label)} END "
        "AS delete_type",
        f"CASE WHEN is_hard_deleted THEN hard_deleted_at WHEN {soft} THEN soft_deleted_at END "
        "AS deleted_at",
    )
