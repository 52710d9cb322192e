"""ledgerlake: cloud-billing (FinOps) analytics as Spark DataFrame jobs.

Sub-packages: ``sources`` (readers), ``functions`` (column helpers), ``operators``
(DataFrame-in / DataFrame-out jobs), ``plans`` (the named query catalog and its SQL
oracle), ``streaming`` (Structured Streaming jobs).
"""

from .session import checkpoint_root, get_session, stage

__all__ = ["checkpoint_root", "get_session", "stage"]
