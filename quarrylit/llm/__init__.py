"""Operators for preparing training data at scale.

Nothing outside this subpackage imports it; its queries live in
:mod:`quarrylit.llm.queries`.
"""
