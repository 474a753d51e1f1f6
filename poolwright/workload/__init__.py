"""Stand-in portfolio data over the supplied tables, and the registered queries."""
