"""Model DAG, query registry and oracle SQL."""
