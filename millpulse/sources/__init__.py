"""Sources: declared raw schemas, yearly file reads, source checks, test role views."""
