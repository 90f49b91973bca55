"""Operators of a training-data pipeline over web documents.

One module per operator, each with a general interface; ``queries.py`` holds the thin
registered queries and ``common.py`` what several operators share. Nothing outside this
folder and ``corpus_pipeline.py`` imports it.
"""
