"""Review stream: messages, bronze, silver upsert, late data."""
