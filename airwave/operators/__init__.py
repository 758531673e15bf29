"""DataFrame-to-DataFrame operators of the audience jobs."""
