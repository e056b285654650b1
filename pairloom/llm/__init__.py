"""Operators that prepare text for language-model training.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
only if the folder is there.
"""
