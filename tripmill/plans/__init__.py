"""Report catalogue, processing flows and the registered queries."""
