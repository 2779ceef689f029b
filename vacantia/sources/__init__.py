"""Scans and payload readers. Importing the package registers every reader."""

from vacantia.sources import aggregators, boards  # noqa: F401
from vacantia.sources.payloads import AGGREGATOR_READERS, BOARD_READERS  # noqa: F401
