"""Operations of a training-data pipeline over document, page and benchmark tables.

Each module holds one operator with its own general interface; ``queries`` registers the thin ``opN_*``
queries and their SQL. Nothing outside this package imports it except the registration in
``__spark_entry__`` and the top-level ``corpus_pipeline``.
"""
