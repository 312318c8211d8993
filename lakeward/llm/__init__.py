"""Operators of a training-data pipeline (see README.md, "Training-data operators").

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers its queries only when
it is present.
"""
