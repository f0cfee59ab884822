"""Training-data operators: ten corpus operators and the queries that apply them.

Nothing outside this subpackage imports it.  Every operator takes a documents
DataFrame (``doc_id``, ``text`` and any further columns) and returns a
DataFrame; ``queries`` registers one query per operator and the pipeline.
"""
