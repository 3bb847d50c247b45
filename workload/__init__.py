"""The registered queries: feeds derived from the given tables, Spark queries and oracle SQL."""
