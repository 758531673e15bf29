"""Column functions: calendar keys, log text, ratios."""
