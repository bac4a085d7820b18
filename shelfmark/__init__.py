"""Dataset conformance and partitioned delivery on Spark."""

from .contracts import Contract, bundled_contracts, load_contracts
from .plans import DatasetSpec, run, run_from_documents
from .session import build_session

__all__ = [
    "Contract", "DatasetSpec", "build_session", "bundled_contracts", "load_contracts", "run",
    "run_from_documents",
]
