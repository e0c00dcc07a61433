"""Fault detection and forecasting over sensor time series, as Spark DataFrame jobs."""

from sensorloom.config import PipelineConfig

__all__ = ["PipelineConfig"]
