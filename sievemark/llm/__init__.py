"""Operations on training data: ten operators over texts, pages and labels, and their queries.

Nothing else in the library imports this package.
"""
