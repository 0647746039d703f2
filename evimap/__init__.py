"""Evidence-map analytics as plain DataFrame operators."""
