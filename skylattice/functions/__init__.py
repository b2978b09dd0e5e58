"""Column expressions; all of them stay inside whole-stage code generation."""
