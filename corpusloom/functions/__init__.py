"""Column-level functions: wikitext cleaning, category names, analyzers."""
