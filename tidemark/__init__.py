"""tidemark: keep tables in step across stores with Spark.

Read a table or query (catalog, Parquet, JDBC) whole or beyond a persisted, typed
high-water mark; stage the batch once while observing its row count and new mark; publish it
by append, schema-replacing overwrite, or keyed merge; keep state and run history as tables.
"""

from .functions.marks import Mark
from .operators import checks
from .operators.transform import filter_rows, from_config, rename_columns, select_columns
from .plans import RunHistory, StateStore, SyncResult, sync, sync_chain
from .sources import CatalogTable, JdbcTable, ParquetPath, QuerySource, ViewTable, create_namespace, namespaces
from .spec import SyncSpec, spec_from_config
from .workspace import shared_root

__all__ = [
    "Mark", "checks", "filter_rows", "from_config", "rename_columns", "select_columns",
    "RunHistory", "StateStore", "SyncResult", "sync", "sync_chain",
    "CatalogTable", "JdbcTable", "ParquetPath", "QuerySource", "ViewTable", "SyncSpec", "spec_from_config",
    "create_namespace", "namespaces",
    "shared_root",
]
