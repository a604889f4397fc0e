"""Independent DuckDB SQL for every registered query (see ``sql.py``)."""

from oracle.sql import ORACLE_SQL  # noqa: F401
