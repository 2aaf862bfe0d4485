"""Registered queries; the optional llm subpackage keeps its own registry."""

from . import annotation_queries, build_queries, join_queries, problems, record_queries, text_queries

REGISTRIES = [problems.R, text_queries.R, join_queries.R, annotation_queries.R, build_queries.R, record_queries.R]
