"""All queries of this subpackage."""

from __future__ import annotations

from scoreloom.llm import corpus_queries, native_queries, text_queries  # noqa: F401
from scoreloom.llm.registry import QUERIES, SQL  # noqa: F401
