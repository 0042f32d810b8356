"""DataFrame -> DataFrame operators of the match warehouse."""
