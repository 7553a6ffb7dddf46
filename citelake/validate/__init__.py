"""Validation of a finished export: structure, coverage, field accuracy, deletions and drift."""

from .run import run_validation

__all__ = ["run_validation"]
