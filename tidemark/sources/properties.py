"""Comments and properties of the tables a source feeds, from its configuration.

The sinks write them beside the data they commit (``tables.describe``); a catalog
table gets them through ``tables.register_table``. Property names are fixed values
that consumers of the tables look up.
"""

from __future__ import annotations

from collections.abc import Mapping


def _tags(src: Mapping) -> dict[str, str]:
    return {f"source.{k}": str(v) for k, v in (src.get("tags") or {}).items()}


def _layer(src: Mapping, quality: str, **more: str) -> dict[str, str]:
    return {"quality": quality, "pipelines.autoOptimize.managed": "true", **more, **_tags(src)}


def staging(src: Mapping) -> tuple[str, dict[str, str]]:
    events = bool((src.get("bronze_options") or {}).get("use_managed_file_events", False))
    mode = "managed_file_events" if events else "directory_listing"
    comment = src.get("description") or f"Staging raw append table: {src.get('source_table')}"
    return comment, _layer(src, "staging", **{"ingestion.file_discovery_mode": mode})


def bronze(src: Mapping) -> tuple[str, dict[str, str]]:
    return src.get("description") or f"Bronze table: {src.get('source_table')}", _layer(src, "bronze")


def silver(src: Mapping) -> tuple[str, dict[str, str]]:
    kind = str(src.get("scd_type", 2))
    comment = src.get("description") or f"Silver SCD{kind} table: {src.get('source_table')}"
    return comment, _layer(src, "silver", **{"silver.scd_type": kind})


def quarantine(src: Mapping) -> tuple[str, dict[str, str]]:
    return f"Quarantine: rows from {src.get('source_table')} that failed data quality rules.", _layer(src, "quarantine")


def rolling(src: Mapping) -> tuple[str, dict[str, str]]:
    """Of a rolling source's change stream, with the settings of both controls."""
    fed, identity = src.get("federated_source") or {}, src.get("row_identity") or {}
    sweep, deletes = src.get("reconciliation") or {}, src.get("delete_detection") or {}
    props = {
        "quality": "staging",
        "pipelines.autoOptimize.managed": "true",
        "ingestion.source_type": "federated",
        "ingestion.foreign_fqn": str(fed.get("foreign_fqn", "")),
        "ingestion.load_mode": "rolling_window",
        "ingestion.window_column": str(fed.get("window_column", "")),
        "ingestion.rolling_window_days": str(fed.get("rolling_window_days", 7)),
        "ingestion.window_start_anchor": str(fed.get("window_start_anchor", "midnight_utc")),
        "ingestion.row_identity_mode": str(identity.get("mode", "hash_all")),
        "ingestion.row_identity_keys": ",".join(identity.get("key_columns") or []),
        "ingestion.delete_detection": str(bool(deletes.get("enabled", True))).lower(),
        "ingestion.reconciliation": str(bool(sweep.get("enabled", False))).lower(),
    }
    if sweep.get("enabled", False):
        props.update({
            "reconcile.cadence_days": str(sweep.get("cadence_days", 7)),
            "reconcile.run_on_weekday": str(sweep.get("run_on_weekday") or ""),
            "reconcile.max_age_days": str(sweep.get("max_age_days") or "full"),
            "reconcile.max_delete_pct": str(sweep.get("max_delete_pct", 5.0)),
            "reconcile.min_source_rows": str(sweep.get("min_source_rows", 1)),
            "reconcile.on_breach": str(sweep.get("on_breach", "fail")),
        })
    return src.get("description") or f"Change stream: {src.get('source_table')}", {**props, **_tags(src)}
