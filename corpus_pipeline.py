"""From raw documents to packed training sequences: the stages are in ``batchledger.llm.pipeline``."""

from batchledger.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
