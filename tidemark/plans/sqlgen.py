"""DuckDB SQL text for the oracle side of the query catalogue.

These strings are the independent specification each Spark query is checked
against (``oracle_sql()``); they are plain SQL over the driver's views.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.functions.hashing import HASH_SEP, NULL_SENTINEL

PROVENANCE_NULLS = ("CAST(NULL AS VARCHAR) AS _source_file_path, CAST(NULL AS VARCHAR) AS _source_file_name, "
                    "CAST(NULL AS BIGINT) AS _source_file_size, CAST(NULL AS TIMESTAMP) AS _source_file_modified")


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def hash_sql(cols: Sequence[str], alias: str | None = None) -> str:
    parts = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '{NULL_SENTINEL}')" for c in sorted(cols))
    expr = f"sha256(concat_ws('{HASH_SEP}', {parts}))"
    return f"{expr} AS {alias}" if alias else expr


def rowkey_sql() -> str:
    return "rowhash || '#' || CAST(rowoccurrence AS VARCHAR)"


def identity_sql(src: str, cols: Sequence[str], id_cols: Sequence[str], with_contenthash: bool = False) -> str:
    """rowhash / rowoccurrence (ordered by contenthash) / rowkey over a subquery."""
    sel = ", ".join(f'"{c}"' for c in cols)
    ch = f", contenthash" if with_contenthash else ""
    return f"""
SELECT {sel}, rowhash{ch}, rowoccurrence, {rowkey_sql()} AS rowkey FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY rowhash ORDER BY contenthash) AS INTEGER) AS rowoccurrence
  FROM (SELECT *, {hash_sql(id_cols, 'rowhash')}, {hash_sql(cols, 'contenthash')} FROM ({src}) _s) _h
) _n"""


def scd2_sql(src: str, cols: Sequence[str], keys: Sequence[str], seq: str, tracked: Sequence[str],
             tie: str | None = None, drop: Sequence[str] = ()) -> str:
    """Gaps-and-islands SCD2 with the same rules as ``operators.scd.scd2``."""
    k = ", ".join(f'"{c}"' for c in keys)
    dedup = src
    if tie:
        dedup = (f"SELECT * EXCLUDE (_tr) FROM (SELECT *, row_number() OVER (PARTITION BY {k}, \"{seq}\" "
                 f"ORDER BY {tie} DESC) AS _tr FROM ({src}) _t) _u WHERE _tr = 1")
    changed = " OR ".join(f'(lag("{c}") OVER w IS DISTINCT FROM "{c}")' for c in tracked) or "FALSE"
    out_cols = ", ".join(f'"{c}"' for c in cols if c not in set(drop))
    return f"""
WITH d AS ({dedup}),
m AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR {changed} THEN 1 ELSE 0 END AS _start
      FROM d WINDOW w AS (PARTITION BY {k} ORDER BY "{seq}")),
i AS (SELECT *, sum(_start) OVER (PARTITION BY {k} ORDER BY "{seq}" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _island FROM m),
l AS (SELECT *, min("{seq}") OVER (PARTITION BY {k}, _island) AS __START_AT,
             row_number() OVER (PARTITION BY {k}, _island ORDER BY "{seq}" DESC) AS _rl FROM i)
SELECT {out_cols}, __START_AT, lead(__START_AT) OVER (PARTITION BY {k} ORDER BY __START_AT) AS __END_AT
FROM l WHERE _rl = 1"""
