"""Every query outside the subpackage llm: QUERIES by name, and ORACLE_SQL with the DuckDB SQL of the same rows."""

from tidemark.queries import agreement, claims, formats, layout, prose, records, relational, series, streams, text  # noqa: F401
from tidemark.queries.registry import ORACLE_SQL, QUERIES  # noqa: F401
