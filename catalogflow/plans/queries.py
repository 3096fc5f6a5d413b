"""Imports every query module, which fills the registry."""

from catalogflow.plans import (  # noqa: F401
    flagship,
    queries_evaluation,
    queries_learning,
    queries_splits,
    queries_tables,
    queries_text,
)
