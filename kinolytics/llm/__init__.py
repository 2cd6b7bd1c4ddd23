"""Operations for preparing language-model training data.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL; every other module is one operator.
"""
