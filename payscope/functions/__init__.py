"""Column helpers the feature families are made of."""
