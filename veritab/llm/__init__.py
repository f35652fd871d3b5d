"""Training-data operators: ten corpus operators and their registered queries.

Nothing outside this folder imports it; see `veritab/llm/queries.py`.
"""
