"""The corpus pipeline of ``telvault.llm.pipeline``, under the names that its callers look for."""

from telvault.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
