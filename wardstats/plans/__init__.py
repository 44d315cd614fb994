from .reports import REPORTS
from .source import AdmissionTable, SummaryTable

__all__ = ["REPORTS", "AdmissionTable", "SummaryTable"]
