"""Batch plans: registered queries, oracle SQL, Silver and Gold runs."""
