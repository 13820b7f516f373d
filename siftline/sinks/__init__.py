"""Writers: topic, object store, index tables, analytic tables."""
