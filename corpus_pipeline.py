"""The corpus pipeline: STAGES, run(spark, sf_dir) and ORACLE_SQL of sessionlens.llm.pipeline."""

from sessionlens.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
