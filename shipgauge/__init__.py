"""shipgauge: delivery and ML-lifecycle metrics as composable Spark DataFrame operators."""

__version__ = "0.1.0"
