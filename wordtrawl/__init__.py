"""Full-text search over page and document tables, as DataFrame operations."""
