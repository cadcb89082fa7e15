"""DataFrame -> DataFrame operators; actions happen only in the quality gate,
the warehouse writers and the pipelines."""
