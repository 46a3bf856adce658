"""Operations of a training-data pipeline over the ``documents`` and ``benchmark`` tables.

Each module is one operator with a general interface; ``queries`` holds the
registered ``opN_<name>`` queries and their SQL.  Nothing outside this
subpackage imports it.
"""
