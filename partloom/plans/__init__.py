"""How a write is spread over tasks, and how long an action may run."""
