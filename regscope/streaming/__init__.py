"""Incremental consolidation: ``landing.append_landed`` appends the partition files
landed since the last run (file source, checkpoint beside the table)."""
