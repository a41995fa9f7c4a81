"""DataFrame-level operators: hierarchy, taxonomy, facets, tokens, search, relevance."""
