"""Nested health records to flat tables, claims and clinical tables, and reports, on Spark."""

from clinflat.operators.flatten import Col, Constant, FlatView, Select, ViewError
from clinflat.session import get_session, prepare

__all__ = ["Col", "Constant", "FlatView", "Select", "ViewError", "get_session", "prepare"]
