"""Column expressions made of built-in functions, so they stay inside code generation."""
