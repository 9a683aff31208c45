"""One-pass data-quality checks with a publish gate.

A check is a named aggregate expression (a count of offending rows, or any
scalar) plus a pass condition on that value.  All checks on one DataFrame are
evaluated in a single aggregate job (one scan) and returned as a DataFrame
``(name, passed, observed, expected)`` -- results stay on the cluster until a
caller asks for the verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    """Raised by :func:`gate` when a check fails and ``on_fail='raise'``."""


@dataclass
class Check:
    name: str
    observed: Column            # aggregate expression -> a number
    expected: str               # 'eq0' | 'gt0'
    description: str = ""


def bad_rows(name: str, condition: Column, description: str = "") -> Check:
    """Passes when no row satisfies ``condition`` (NULL counts as not bad)."""
    return Check(name, F.count_if(F.coalesce(condition, F.lit(False))), "eq0", description)


def row_count_positive(name: str) -> Check:
    return Check(name, F.count(F.lit(1)), "gt0", "table is not empty")


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run every check in one aggregate; one result row per check."""
    # an aggregate over no rows (or a sum of no matches) observes 0, not NULL
    values = df.agg(*[F.coalesce(c.observed.cast("long"), F.lit(0)).alias(f"c{i}")
                      for i, c in enumerate(checks)])
    rows = [F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("observed"),
                     F.lit(c.expected).alias("expected"))
            for i, c in enumerate(checks)]
    out = values.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    passed = (F.when(F.col("expected") == "eq0", F.col("observed") == 0)
              .otherwise(F.col("observed") > 0))
    return out.select("name", F.coalesce(passed, F.lit(False)).alias("passed"),
                      "observed", "expected")


def evaluate_while_writing(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], object]) -> DataFrame:
    """Run the checks on the rows that ``write`` writes, as it writes them (observed
    metrics): the same results as :func:`evaluate`, without reading the rows again.

    ``write`` gets the frame and must write it as it is, in one job: then the metrics are
    collected by the tasks that write, and only the attempt of a task that is committed
    counts.  The checks must be plain aggregates (no distinct counts)."""
    seen = Observation()
    write(df.observe(seen, *[F.coalesce(c.observed.cast("long"), F.lit(0)).alias(f"c{i}") for i, c in enumerate(checks)]))
    found = [(c.name, seen.get[f"c{i}"], c.expected) for i, c in enumerate(checks)]
    return df.sparkSession.createDataFrame(
        [(name, n == 0 if expected == "eq0" else n > 0, n, expected) for name, n, expected in found],
        "name string, passed boolean, observed long, expected string")


def verdict(results: DataFrame) -> DataFrame:
    """One row: ``all_passed`` and ``failed`` (count of failed checks).  No results have
    not passed."""
    return results.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("all_passed"),
                       F.count_if(~F.col("passed")).cast("long").alias("failed"))


ON_FAIL = ("raise", "warn", "block")


def check_mode(on_fail: str) -> None:
    if on_fail not in ON_FAIL:
        raise ValueError(f"on_fail must be one of {ON_FAIL}, not {on_fail!r}")


def gate(results: DataFrame, on_fail: str = "raise") -> bool:
    """Publish gate: evaluate the verdict (one small job) and raise, warn, or just
    return False (``block``).  A table without any result fails."""
    check_mode(on_fail)
    found = results.select("name", "passed").collect()
    failed = [r["name"] for r in found if not r["passed"]] if found else ["no check was run"]
    if failed and on_fail == "raise":
        raise QualityGateError(f"quality checks failed: {', '.join(failed)}")
    if failed and on_fail == "warn":
        import warnings
        warnings.warn(f"quality checks failed: {', '.join(failed)}", stacklevel=2)
    return not failed
