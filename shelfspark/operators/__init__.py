"""DataFrame-to-DataFrame operators over the model schemas."""
