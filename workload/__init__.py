"""The registered queries: the library's operators run over the shared test tables."""
