"""DataFrame-to-DataFrame operators, chained with ``DataFrame.transform``."""
