"""conform — conform recurring file drops from differently shaped sources into one model.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; writing happens only at the edges (``conform.sources.tables``,
``conform.streaming``) and in the composed jobs under ``conform.plans``.
"""

from conform.context import RunContext, audit_stamp
from conform.spec import DerDataset, SourceSpec

__all__ = ["RunContext", "audit_stamp", "SourceSpec", "DerDataset"]
