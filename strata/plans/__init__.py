"""Jobs, fixtures and the registered driver queries."""
