"""DataFrame -> DataFrame operators (lazy; Catalyst plans them)."""
