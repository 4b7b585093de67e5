"""Operators of a training-data pipeline. Nothing else in the package imports
this folder; ``__spark_entry__.py`` adds its queries when it is present."""
