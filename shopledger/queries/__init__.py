"""The operators run on the generated test tables, each with its SQL twin."""
