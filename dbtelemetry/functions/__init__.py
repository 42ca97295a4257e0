"""Column helpers for T-SQL scalar semantics."""

from dbtelemetry.functions.tsql import *  # noqa: F401,F403
