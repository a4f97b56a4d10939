"""tallyworks: daily operations extracts to monthly reports, as Spark jobs."""

from tallyworks.plans.params import ReportParams
from tallyworks.plans.workspace import Workspace

__all__ = ["ReportParams", "Workspace"]
