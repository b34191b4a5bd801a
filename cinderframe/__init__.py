"""cinderframe: plant-emissions analytics as Spark DataFrame transformations."""

from .config import DEFAULT, PipelineConfig

__all__ = ["DEFAULT", "PipelineConfig"]
__version__ = "0.1.0"
