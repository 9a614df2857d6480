"""Column builders; every function returns a Catalyst expression and stays inside whole-stage code generation."""
