"""Inpatient admission analytics on Spark."""

from .columns import ColumnMap
from .plans import REPORTS, AdmissionTable, SummaryTable
from .session import session_builder
from .sources import read_admissions, star_admissions

__all__ = [
    "REPORTS", "AdmissionTable", "ColumnMap", "SummaryTable", "read_admissions",
    "session_builder", "star_admissions",
]
