"""Regenerate INVENTORY.md: survey inventory ID -> implementation -> queries."""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

IMPL = {
    "B1": "sources.delivery.read_pipe_csv / ingest_lines", "B2": "sources.delivery.with_lineage",
    "B3": "functions.columns.file_date_from_name", "B4": "sources.delivery.ingest_enrollment",
    "B5": "sources.delivery.ingest_snapshot", "B6": "sources.delivery.ingest_change",
    "B7": "sources.tables.RunTable.read / DeliveryTable.read",
    "B8": "sources.tables.RunTable.write / DeliveryTable.append",
    "B9": "spark.sql over parquet.`path`", "B10": "plans.reports.q_feed_coverage",
    "P1": "operators.reconcile.align", "P2": "SourceSpec.tag", "P3": "functions.columns.account_from_legacy",
    "P4": "plans.phone_state.build_state / build_consent", "P5": "operators.latest.latest_by (window form)",
    "P6": "operators.decide.lookup", "P7": "Column.rlike in reports / quality",
    "P8": "operators.quality.bad_rows, count_if(isNull)", "P9": "isin domain lists (reports.q_domain_check)",
    "P10": "startswith / normalize_phone",
    "J1": "operators.merge.gap_fill (and fallback class in reconcile)",
    "J2": "operators.deletes.absent_from_latest (folded into reconcile)",
    "J3": "operators.deletes.flag_deletes (folded into reconcile)",
    "J4": "per-phone countDistinct (re-aimed self join)", "J5": "grouped counts of the winners (no join)",
    "J6": "left_semi joins", "J7": "scalar subquery of a grouped min", "J8": "left_semi + scalar subquery",
    "J9": "operators.merge.upsert / sources.tables.KeyedTable.merge",
    "A1": "operators.deletes.latest_snapshot_date (scalar subquery)", "A2": "groupBy.max",
    "A3": "operators.deletes.absent_from_latest / presence", "A4": "groupBy.count", "A5": "reports._dups (two-level)",
    "A6": "count_if", "A7": "groupBy + countDistinct + filter", "A8": "min/max/count",
    "A9": "reports.with_share (exact half-up)", "A10": "distinct via per-key aggregate",
    "A11": "groupBy on CASE expression", "A12": "scalar subqueries", "A13": "ratio aggregate",
    "W1": "plans.phone_state.dedup_snapshot", "W2": "plans.phone_state.dedup_change",
    "W3": "plans.phone_state.latest_snapshot_state", "W4": "plans.phone_state.latest_change_state",
    "W5": "operators.reconcile.reconcile (precedence order)", "W6": "operators.latest.latest_by",
    "W7": "Window.partitionBy() over grouped rows",
    "S1": "orderBy", "S2": "orderBy.limit (top-k)", "S3": "ordered sample",
    "U1": "unionByName", "U2": "tagged union + one aggregate", "U3": "operators.merge.bag_difference (digests; exceptAll only if they differ)",
    "F1": "substring/length", "F2": "functions.columns.normalize_phone", "F3": "regexp_extract",
    "F4": "functions.columns.parse_date (try_to_date)", "F5": "functions.columns.tri_state",
    "F6": "coalesce + three-valued logic (delete_status)", "F7": "CASE precedence (delete_status)",
    "F8": "date comparisons", "F9": "exact rounding",
    "C1": "operators.deletes.flag_deletes", "C2": "operators.reconcile.delete_status (re-add)",
    "C3": "operators.reconcile.delete_status", "C4": "plans.phone_state.build_state",
    "C5": "plans.phone_state.build_consent", "C6": "operators.decide.decide / can_send_sms",
    "C7": "operators.decide.denial_reason", "C8": "reports.q_compliance_boundaries",
    "Q1": "operators.quality.evaluate (feed checks)", "Q2": "reports.published_quality",
    "Q3": "reports.published_quality", "Q4": "operators.quality.verdict / gate",
    "Q5": "count_if consistency", "Q6": "count_if(isNull)", "Q7": "row parity",
    "I1": "operators.merge.upsert / RunTable.upsert / KeyedTable.merge", "I2": "RunTable.upsert (create)",
    "I3": "operators.merge.diff / RunTable.changes (digests per key bucket first)", "I4": "RunTable.read(run), RunTable.runs, RunTable.history",
    "I5": "_source_file carried in the winning row; plans.phone_state.column_lineage", "I6": "plans.phone_state.consent_history / consent_as_of / consent_validity",
    "X1": "streaming.change_stream.run_change_stream / streaming.served.serve_changes",
}


def main() -> None:
    from contactgate.plans.catalog import REGISTRY, _load_all
    _load_all()
    ids: dict[str, list[str]] = {}
    for q in REGISTRY.values():
        for i in q.ids.split():
            ids.setdefault(i, []).append(q.name + ("" if q.oracle else " (rows only)"))

    def order(k):
        return re.match(r"[A-Z]+", k).group(), int(re.search(r"\d+", k).group())

    lines = ["# Inventory coverage", "",
             "SURVEY §2 ID -> implementation (module paths under `contactgate/`) -> "
             "registered queries (all DuckDB-checked unless marked). Generated by "
             "`tools/inventory.py`.", "",
             "| ID | implementation | queries |", "| --- | --- | --- |"]
    for k in sorted(set(IMPL) | set(ids), key=order):
        lines.append(f"| {k} | {IMPL.get(k, '')} | {', '.join(ids.get(k, [])) or '–'} |")
    lines += ["", f"{len(REGISTRY)} registered queries, "
              f"{sum(1 for q in REGISTRY.values() if q.oracle)} with an oracle."]
    with open(os.path.join(ROOT, "INVENTORY.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
