"""Column-level functions (pure ``Column -> Column``, JVM-side, codegen friendly)."""
