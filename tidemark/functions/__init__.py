"""Column-level helpers (all JVM-side built-ins, no UDFs)."""

from tidemark.functions.hashing import HASH_SEP, NULL_SENTINEL, row_hash
from tidemark.functions.names import normalize_identifier
from tidemark.functions.bounds import at_or_after

__all__ = ["HASH_SEP", "NULL_SENTINEL", "row_hash", "normalize_identifier", "at_or_after"]
