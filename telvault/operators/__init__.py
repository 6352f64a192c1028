"""DataFrame operators: staging, features, vault, marts, quality, catalog, metrics."""
