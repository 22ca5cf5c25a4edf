"""Job plans: stage functions (E1), the full run (E2) and the registered query catalog."""
