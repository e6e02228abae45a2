"""Dataset builders: silver, labelling, gold, maintenance, validation."""
