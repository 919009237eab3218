"""DataFrame operators. Series are told apart by key columns, never by order alone."""
