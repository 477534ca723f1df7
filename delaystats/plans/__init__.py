"""Query catalog, oracle SQL and plan inspection."""
