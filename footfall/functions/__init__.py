"""Column builders: no job is planned here, only expressions."""
