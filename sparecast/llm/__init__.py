"""Operations of a training-data pipeline over the ``documents`` and ``pages`` tables.

One module per operator; ``queries`` registers one query for each.  Nothing
else in the library imports this subpackage.
"""
