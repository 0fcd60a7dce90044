"""End-to-end flows and the named-query registry."""
