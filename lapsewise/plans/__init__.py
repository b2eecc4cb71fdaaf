"""The build: features, labels, training set, checks, split, models, serving table."""
