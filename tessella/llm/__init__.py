"""Operators that prepare text, page and vector corpora for model training.

Names that begin with two underscores are reserved for columns in between: operators that hand on a table's columns
leave such input columns out.
"""
