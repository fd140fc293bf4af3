"""All queries by name with the SQL that gives the same rows."""

from __future__ import annotations

from captureframe.plans import fitting, imaging, measure, report, scenes, sequence, statistics  # noqa: F401
from captureframe.plans.registry import ORACLES, QUERIES  # noqa: F401
from captureframe.plans.report import flagship  # noqa: F401
