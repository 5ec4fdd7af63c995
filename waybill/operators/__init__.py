"""DataFrame -> DataFrame transformations, shared by batch and stream where possible."""
