"""Operators for preparing large text corpora.

One module per operator, each a DataFrame-in, DataFrame-out function with its
own general interface; ``queries`` holds the thin registered queries.  Nothing
else in the library imports this subpackage.
"""
