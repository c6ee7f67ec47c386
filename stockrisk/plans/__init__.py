"""Job composition, the query catalogue and its SQL oracle."""
