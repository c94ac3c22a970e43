"""moniker: links the chemical mentions of a document collection to substance ids.

The package reads recognised mentions, derives lookup keys as native column
expressions, resolves every distinct word once by shuffle joins with the
dictionaries and publishes bucketed tables. See README.md for a tour.
"""
