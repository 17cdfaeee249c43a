"""DataFrame-to-DataFrame operators on the long abundance model."""
