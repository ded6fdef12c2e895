"""Training-data operators: tokens, chat text, dedup, language, files, HTML.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin
registered queries; every other module is one operator with its own interface.
"""
