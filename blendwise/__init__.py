"""blendwise: blended marketing and commerce reporting on Spark DataFrames."""

__version__ = "0.1.0"
