"""Registered queries, one or more per operator, each with an independently written SQL check.

Every query reads a data folder through the views of `plans.inputs`; money leaves as double, times as text.
"""

from ledgerloom.catalog import documents, extracts, reporting, staff, statuses, whole_runs  # noqa: F401
from ledgerloom.catalog.registry import CHECKS, QUERIES  # noqa: F401
