"""DuckDB oracle SQL for the registered queries."""

from oracle.history_sql import HISTORY_ORACLE
from oracle.requests_sql import REQUEST_ORACLE
from oracle.sql import ORACLE as PANEL_ORACLE

ORACLE = {**PANEL_ORACLE, **REQUEST_ORACLE, **HISTORY_ORACLE}

__all__ = ["ORACLE"]
