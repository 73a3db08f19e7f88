"""Training-data operators: scoring, filtering, deduplication, packing, encoding and archives.

Nothing outside this subpackage imports it; its queries are in ``lakeweave.llm.queries``.
"""
