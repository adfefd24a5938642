"""Daily-bar analytics on Spark: raw OHLCV bars -> refined features -> monthly summary."""

from barwright.config import FeatureSpec, PipelineConfig, RunResult, configure_session

__all__ = ["FeatureSpec", "PipelineConfig", "RunResult", "configure_session"]
