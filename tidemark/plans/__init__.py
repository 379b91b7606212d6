"""Compositions: state, run history and the end-to-end sync."""

from .history import RunHistory
from .state import StateStore
from .sync import SyncResult, sync, sync_chain

__all__ = ["RunHistory", "StateStore", "SyncResult", "sync", "sync_chain"]
