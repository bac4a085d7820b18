"""Queries, configuration documents and destination listings."""

from .clouds import Destination, apply_hadoop_conf, destinations, read_clouds
from .listing import list_objects, read_dataset
from .queries import AnySplit, CatalogSource, JdbcSource, MonthSplit, QuantileSplit, Split, connection_settings, mysql_source
from .registry import (
    RegistryError,
    dataset_queries,
    document_faults,
    read_tenants,
    select_dataset,
    tenant_document,
    workers,
)

__all__ = [
    "AnySplit", "CatalogSource", "Destination", "JdbcSource", "MonthSplit", "QuantileSplit",
    "RegistryError", "Split", "apply_hadoop_conf", "connection_settings", "dataset_queries",
    "destinations", "document_faults", "list_objects", "mysql_source",
    "read_clouds", "read_dataset", "read_tenants", "select_dataset", "tenant_document", "workers",
]
