"""Column expressions that decode OCPP calls."""
