"""Multi-step jobs: model training, rolling validation, scoring, and the query catalog."""
