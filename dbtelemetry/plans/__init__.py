"""Composed reports and the registry the driver contract reads."""

from __future__ import annotations

import importlib

_MODULES = (
    "dbtelemetry.plans.activity_reports",
    "dbtelemetry.plans.schema_reports",
    "dbtelemetry.plans.job_reports",
    "dbtelemetry.plans.event_reports",
)


def all_reports():
    from dbtelemetry.plans.catalog import REPORTS

    for m in _MODULES:
        importlib.import_module(m)
    return REPORTS
