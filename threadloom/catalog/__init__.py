"""Test-table views, the registered queries and their SQL counterparts."""
