"""Web-search analytics on Spark DataFrames: pages, link graph, text index, search, link analysis."""
