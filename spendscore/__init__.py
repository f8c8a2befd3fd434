"""Customer spend analytics and scoring on Spark DataFrames."""

from spendscore.config import PipelineConfig, ScoreRule

__all__ = ["PipelineConfig", "ScoreRule"]
