"""kinetable: robot-trajectory recordings and their catalogue as Spark DataFrames."""

__version__ = "0.1.0"
