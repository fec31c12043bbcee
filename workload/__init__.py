"""The registered queries: crawl tables derived from the given tables, with oracle SQL."""
