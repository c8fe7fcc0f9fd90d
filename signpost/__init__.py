"""Web-surface analytics as Spark jobs: fetch log -> outcomes -> receipts -> public index."""
