"""The queries of the driver contract, each beside its SQL oracle."""
