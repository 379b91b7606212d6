"""Stores a sync reads from and publishes to: catalog tables, tables behind views, SQL queries, Parquet, JDBC."""

from .base import Store
from .catalog import CatalogTable, QuerySource, create_namespace, namespaces
from .files import ParquetPath
from .jdbc import JdbcTable
from .views import ViewTable

__all__ = ["Store", "CatalogTable", "QuerySource", "ParquetPath", "JdbcTable", "ViewTable", "create_namespace", "namespaces"]
