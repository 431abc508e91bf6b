"""Feature families: each takes an event log and gives one row per user."""
