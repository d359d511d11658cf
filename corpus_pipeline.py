"""From raw documents to a mix for training: the stages of `plotstats.llm.pipeline`."""

from plotstats.llm.pipeline import ORACLE_SQL, STAGES, run, without_benchmark

__all__ = ["ORACLE_SQL", "STAGES", "run", "without_benchmark"]
