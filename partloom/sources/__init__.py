"""Where SQL text, table definitions and files come from."""
