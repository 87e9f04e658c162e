"""Job compositions, parameters and the registered checks."""
