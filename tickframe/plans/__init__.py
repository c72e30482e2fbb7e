"""Jobs, checks, registered queries and SQL views."""
