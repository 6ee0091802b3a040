"""Column expressions of the incident model (all JVM-side, codegen-friendly)."""
