"""Operators bound to the given tables. Importing registers every query."""

from proofs import jobs_io, payloads, rules, scalars, tables  # noqa: F401
from proofs.base import PROOFS, Tables  # noqa: F401
