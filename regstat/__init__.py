"""regstat — public statistical registers (establishments, employment links,
municipal GDP) decoded, harmonised, classified and summarised on Spark."""

__version__ = "0.1.0"
