"""Column helpers: plain expressions that stay inside whole-stage code generation."""
