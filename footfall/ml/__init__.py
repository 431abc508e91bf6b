"""User-level modelling: encoding, folds, trees, scores."""
