"""Corpus pipeline: documents through five of the operators, stage by stage."""

from __future__ import annotations

from tickvault.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
