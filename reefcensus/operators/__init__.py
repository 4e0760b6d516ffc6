"""DataFrame -> DataFrame operators of the survey engine."""
