"""Reading, routing and writing envelopes."""
