"""docquarry: document discovery and classification over large corpora, on Spark."""
