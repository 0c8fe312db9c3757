"""End-to-end plans: query catalog, batch scoring, training, tracking."""
