"""Operators for preparing language-model training text.

One module per operator; ``entries`` holds the registered queries.  Nothing
else in the library imports this package.
"""
