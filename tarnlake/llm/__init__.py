"""Operators for preparing language-model training data at cluster scale.

Nothing outside this subpackage imports it; ``tarnlake.llm.queries`` holds the
registered queries and their SQL.
"""
