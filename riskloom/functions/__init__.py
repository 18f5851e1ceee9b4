"""Column -> Column rules. Everything here stays inside whole-stage code generation."""
